"""Small tables with the cases every operator has to take: nulls, empty and long texts, ties, repeats, odd columns."""

from __future__ import annotations

EN = "the cat sat on the mat and the dog ran over the hill to see the old house by the river where it was born"
DE = "der Hund lief durch den Wald und die Katze schlief auf dem Dach bis der Morgen kam und es wieder hell wurde"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
EXTRA = "n long, key string, code long, start long, rank int, template string, weight double, budget long, pii_base string, row string, cuts int"


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); the other columns carry names that operators use inside."""
    full = [(*r, *[None] * (4 - len(r)))[:4] for r in rows]
    values = [(i, t, lang, source, None if t is None else len(t), 1, "k", 2, 3, 4, "t", 0.5, 6, "b", "r", 7) for i, t, lang, source in full]
    return spark.createDataFrame(values, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


def cases():
    return [
        (1, EN, "en", "src1"), (2, EN, "en", "src1"), (2, EN, "en", "src1"), (3, None, "en", "src2"), (4, "", None, None), (5, " \n\t ", "de", "src2"),
        (6, DE, "de", "src3"), (7, LONG, "en", "src1"), (None, EN, "en", "src1"), (None, None, None, None), (8, "x", "en", "src9"), (9, "é ß 日本 !!", "fr", "src9"),
        (10, EN + " at last", "en", "src1"), (11, "?!;", "en", "src1"),
    ]


def rows_of(df, *names):
    names = names or df.columns
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))
