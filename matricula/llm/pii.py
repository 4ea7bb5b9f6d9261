"""Personal data: span generators, boosted trees over format and context, calibrated thresholds.

Four base kinds are validated matches and always stay.  Wider generators propose further spans that may overlap them
(card- or phone-like digit groups, spelled-out addresses, identifiers after a cue word, long keys).  A proposal that
passes its pattern's own check stays, as does one of a pattern that has none; boosted trees score the others from their
format and their surroundings, and a threshold per pattern, calibrated on half of the evidence, selects.
All of it is column expressions; the trees are fitted on a table of counts whose size is bounded by the feature bins.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matricula.llm.text import spans

# The base kinds in their order.
BASE_KINDS = ("email", "ip", "card", "phone")

# The stated patterns, written so that no run of characters is searched twice and no group recurses: a run is entered
# at its first character or where the previous match ended, and repeats give nothing back.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

# Proposals beyond the base: kind, pattern, a substring or pattern without which the text is not searched.
PROPOSALS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)| dot |\.) ?[A-Za-z0-9-]{1,63}){1,4}", r"(?:\[at\]|\(at\)| at )"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", r":[0-9A-Fa-f]{1,4}:"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}"),
    ("number", r"(?<![A-Za-z0-9+.-])[0-9](?:[ -]?[0-9]){6,18}(?![A-Za-z0-9])", r"[0-9]"),
    ("phone", r"(?<![0-9])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])", r"[0-9][ .-][0-9]"),
    ("key", r"(?<![A-Za-z0-9])(?=[A-Za-z]{0,39}[0-9])[A-Za-z0-9_-]{24,128}(?![A-Za-z0-9])", r"[A-Za-z0-9_-]{24}"),
)
KINDS = (*BASE_KINDS, "iban", "number", "key")
# The kind of every pattern: first the base patterns, then the proposals in their order.
FORMS = (*BASE_KINDS, *(kind for kind, _, _ in PROPOSALS))
SPELLED, GROUPS, IBAN, LOCAL, KEY = 4, 5, 6, 8, 9
# Nothing tells right from wrong matches of these; they are no evidence.
UNCHECKED = (LOCAL, KEY)

# Words before a span that speak for its kind, in the order of their feature values 1, 2, ...
CUES = ("mail|e-mail|contact|write to", "ip|host|addr|server", "card|visa|credit|karte|carte|tarjeta", "phone|tel|call|mobile|fax", "iban|account|konto", "ssn|passport|id|no\\.?|nr\\.?", "key|token|secret|password|api")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, r"[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Whether the digits pass the check sum: from the right, every second one doubled, nines cast out."""
    back = F.reverse(_digits(match))
    total = F.aggregate(F.sequence(F.lit(1), F.char_length(back)), F.lit(0), lambda a, i: a + F.when(
        i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int"),
    ).otherwise(F.substring(F.lit("0246813579"), F.substring(back, i, F.lit(1)).cast("int") + 1, F.lit(1)).cast("int")))
    return total % 10 == 0


def _parts_hold(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^[0-9]{1,3}$") & (F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 3).cast("int") <= 255))


def _is_address(match: Column) -> Column:
    """Whether a spelled-out address, its signs put back, is a mail address with a name of letters at its end."""
    plain = F.regexp_replace(F.regexp_replace(match, r" ?(?:\[at\]|\(at\)| at ) ?", "@"), r" ?(?:\[dot\]|\(dot\)| dot ) ?", ".")
    return plain.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")


def _is_iban(match: Column) -> Column:
    """Whether the check digits hold: the first four signs moved to the end, letters as 10 to 35, leave 1 by 97."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    left = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).when(c <= "9", (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int"))
    return F.char_length(plain).between(15, 34) & (left == 1)


def _passes(match: Column, form: int) -> Column:
    """Whether a proposal beyond the base passes its own check; where it has none, whether its pattern is enough.

    A number is checked as a card, which makes it a base span."""
    if form == SPELLED:
        return _is_address(match)
    if form == GROUPS:
        return F.size(F.split(match, ":")) == 8
    if form == IBAN:
        return _is_iban(match)
    if form == LOCAL:
        return F.char_length(_digits(match)).between(9, 15)
    return F.lit(form == KEY)


def base_spans(text: Column) -> Column:
    """Valid matches of the four base kinds as array<struct<start, rank, end, kind>>, by start and then kind."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    long_enough = lambda low, high: lambda s: F.char_length(_digits(s["match"])).between(low, high)
    found = (
        F.when(text.contains("@"), spans(text, EMAIL)).otherwise(none),
        F.filter(F.when(text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), spans(text, IP)).otherwise(none), lambda s: _parts_hold(s["match"])),
        F.filter(F.filter(F.when(text.rlike(r"[0-9](?:[ -]?[0-9]){11}"), spans(text, CARD)).otherwise(none), long_enough(12, 19)), lambda s: _luhn(s["match"])),
        F.filter(F.when(text.contains("+"), spans(text, PHONE)).otherwise(none), long_enough(9, 15)),
    )

    def named(rank: int, kind: str) -> Column:
        return F.transform(found[rank], lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    return F.array_sort(F.concat(*[named(rank, kind) for rank, kind in enumerate(BASE_KINDS)]))


def _with_context(text: Column, found: Column, form: int) -> Column:
    """Each proposal with its feature bins, 0 being the bin for "none of these", and whether it passes."""

    def features(s: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(F.lit(1), s["start"] - 23).cast("int"), F.least(F.lit(24), s["start"]).cast("int")))
        after = F.substring(text, (s["end"] + 1).cast("int"), F.lit(1))
        n = F.char_length(_digits(s["match"]))
        cue = F.lit(0)
        for i, words in reversed(list(enumerate(CUES, 1))):
            cue = F.when(before.rlike(rf"(?:^|[^a-z])(?:{words})[^a-z]{{0,4}}$"), F.lit(i)).otherwise(cue)
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.lit(form).alias("kind"),
            F.least(n, F.lit(20)).alias("digits"),
            F.least(F.char_length(s["match"]) - n, F.lit(8)).alias("others"),
            F.when(s["match"].contains("@"), 1).when(s["match"].contains("["), 6).when(s["match"].contains("("), 2).when(s["match"].contains(" dot "), 7).when(s["match"].contains(" "), 3).when(s["match"].contains("."), 4).when(s["match"].contains("-"), 5).otherwise(0).alias("marks"),
            F.when(before == "", 1).when(before.rlike(r"[+]$"), 2).when(before.rlike(r"[a-z0-9]$"), 3).when(before.rlike(r"\s$"), 4).otherwise(0).alias("left"),
            F.when(after == "", 1).when(after.rlike(r"[A-Za-z0-9]"), 2).when(after.rlike(r"[.,;:]"), 3).when(after.rlike(r"\s"), 4).otherwise(0).alias("right"),
            cue.alias("cue"),
            _passes(s["match"], form).alias("passes"),
        )

    return F.transform(found, features)


FEATURES = ("kind", "digits", "others", "marks", "left", "right", "cue")


def proposals(text: Column) -> Column:
    """All wide proposals with their features; they may overlap each other and the base spans."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    wide = [(kind, pattern, gate) for kind, pattern, gate in (
        ("email", EMAIL, "@"), ("ip", IP, r"[0-9]\.[0-9]++\.[0-9]"), ("card", CARD, r"[0-9](?:[ -]?[0-9]){7}"), ("phone", PHONE, r"\+"), *PROPOSALS)]
    return F.concat(*[_with_context(text, F.when(text.rlike(gate), spans(text, pattern)).otherwise(none), form) for form, (_, pattern, gate) in enumerate(wide)])


def evidence(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Counts of proposals per feature bin over all documents, with how many of them are good.

    Evidence comes from patterns whose matches can be checked: a match of the base patterns or a number is good if it is
    exactly a validated base span; a spelled-out address if it is one with its signs put back; an IP of hexadecimal
    groups if it has eight; an IBAN if its check digits hold.  Matches that fail their check are the negatives; UNCHECKED
    patterns give neither.  fold splits by text, so copies stay together."""
    seen = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.col("text").rlike(r"[0-9@]| at |\(at\)|\[at\]"))
    each = seen.select(F.pmod(F.xxhash64("text"), F.lit(2)).alias("fold"), base_spans(F.col("text")).alias("base"), proposals(F.col("text")).alias("wide"))
    rows = each.select("fold", "base", F.explode("wide").alias("p")).where(~F.col("p.kind").isin(*UNCHECKED))
    valid = F.when(F.col("p.kind").isin(SPELLED, GROUPS, IBAN), F.col("p.passes")).otherwise(F.exists("base", lambda b: (b["start"] == F.col("p.start")) & (b["end"] == F.col("p.end"))))
    return rows.groupBy("fold", *[F.col(f"p.{f}").alias(f) for f in FEATURES]).agg(F.count("*").alias("n"), F.sum(valid.cast("long")).alias("good"))


@dataclass
class Boosted:
    """Trees of two splits over bins; leaf values add up to log-odds.  threshold: per pattern (the feature kind), the
    least accepted chance.  bare: nothing beyond the base is looked for."""

    prior: float = 0.0
    trees: list[tuple[int, int, int, int, float, float, float]] = field(default_factory=list)
    threshold: dict[int, float] = field(default_factory=dict)
    bare: bool = True

    def margin(self, x) -> float:
        total = self.prior
        for f, v, g, w, both, one, none in self.trees:
            total += (both if x[g] <= w else one) if x[f] <= v else none
        return total

    def column(self, of) -> Column:
        """The chance as a column; of(name) gives a feature's column."""
        total = F.lit(self.prior)
        for f, v, g, w, both, one, none in self.trees:
            total = total + F.when(of(FEATURES[f]) <= v, F.when(of(FEATURES[g]) <= w, F.lit(both)).otherwise(F.lit(one))).otherwise(F.lit(none))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(counts: list, rounds: int = 24, rate: float = 0.4, ridge: float = 1.0, precision: float = 0.9) -> Boosted:
    """Boosts trees on the counts of fold 0 and sets each pattern's threshold on fold 1, so that at least `precision` of
    what passes is good.  counts: rows of evidence(), as many as bins are in use; without positives or negatives
    the trees accept nothing."""
    def table(fold):
        out: dict[tuple, list[float]] = {}
        for r in counts:
            if r["fold"] == fold:
                cell = out.setdefault(tuple(r[f] for f in FEATURES), [0.0, 0.0])
                cell[0] += r["n"]
                cell[1] += r["good"]
        return sorted((x, n, g) for x, (n, g) in out.items())

    train, held = table(0), table(1)
    total, good = sum(n for _, n, _ in train), sum(g for _, _, g in train)
    model = Boosted(bare=False)
    if not total or not 0 < good < total:
        return model
    model.prior = log(good / (total - good))
    cuts = [(f, v) for f in range(len(FEATURES)) for v in sorted({x[f] for x, _, _ in train})[:-1]]
    margins = [model.prior] * len(train)
    leaf = lambda g, h: rate * g / (h + ridge)
    gain = lambda g, h: g * g / (h + ridge)

    def best(rows):
        """The cut of most gain over rows of (x, gradient, curvature)."""
        all_g, all_h, found = sum(r[1] for r in rows), sum(r[2] for r in rows), (0.0, None)
        sums: dict[tuple[int, int], list[float]] = {}
        for x, g, h in rows:
            for f, v in enumerate(x):
                cell = sums.setdefault((f, v), [0.0, 0.0])
                cell[0] += g
                cell[1] += h
        left: dict[int, list[float]] = {}
        for f, v in sorted(sums):
            cell = left.setdefault(f, [0.0, 0.0])
            cell[0] += sums[f, v][0]
            cell[1] += sums[f, v][1]
            score = gain(*cell) + gain(all_g - cell[0], all_h - cell[1]) - gain(all_g, all_h)
            if score > found[0] + 1e-9 and (f, v) in known:
                found = (score, (f, v))
        return found[1]

    known = set(cuts)
    for _ in range(rounds):
        rows = []
        for (x, n, g), m in zip(train, margins, strict=True):
            p = 1 / (1 + exp(-max(-30.0, min(30.0, m))))
            rows.append((x, g - n * p, n * p * (1 - p)))
        top = best(rows)
        if top is None:
            break
        inside = [r for r in rows if r[0][top[0]] <= top[1]]
        second = best(inside) or top
        sums = [[0.0, 0.0] for _ in range(3)]
        for x, g, h in rows:
            k = 2 if x[top[0]] > top[1] else 1 if x[second[0]] > second[1] else 0
            sums[k][0] += g
            sums[k][1] += h
        model.trees.append((*top, *second, *(leaf(*s) for s in sums)))
        margins = [model.margin(x) for x, _, _ in train]
    for kind in range(len(FORMS)):
        ranked = sorted(((1 / (1 + exp(-max(-30.0, min(30.0, model.margin(x))))), n, g) for x, n, g in held or train if x[0] == kind), reverse=True)
        seen = right = 0.0
        for chance, n, g in ranked:
            seen, right = seen + n, right + g
            if right + 1 >= precision * (seen + 2):
                model.threshold[kind] = chance
    # Patterns beyond the base with too little evidence take the mean of the others' thresholds.
    if model.threshold:
        usual = sum(model.threshold.values()) / len(model.threshold)
        for kind in range(len(BASE_KINDS), len(FORMS)):
            if kind not in UNCHECKED:
                model.threshold.setdefault(kind, max(usual, 0.5))
    return model


def find(docs: DataFrame, model: Boosted | None = None, text_col: str = "text") -> DataFrame:
    """docs with columns pii_base and pii_spans added: arrays of struct<start, rank, end, kind> by start, then kind.

    pii_spans holds the base spans and, outside them, the proposals that pass their own check or whose pattern has none
    and those that the trees accept; a bare model gives the base spans alone.  Rows are independent: nulls and
    empty texts have no spans, repeated rows equal ones, a long text is one row's work in proportion to its length.
    Without a model one is fitted on the documents themselves."""
    model = fit_on(docs, text_col) if model is None else model
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.withColumn("pii_base", F.when(text.rlike("[0-9@]"), base_spans(text)).otherwise(F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")))
    named = F.array(*[F.lit(k) for k in FORMS])
    ranks = F.array(*[F.lit(KINDS.index(k)) for k in FORMS])

    def accepted(p: Column) -> Column:
        needed = F.lit(2.0)
        for kind, chance in sorted(model.threshold.items()):
            needed = F.when(p["kind"] == kind, F.lit(chance - 1e-9)).otherwise(needed)
        return (p["passes"] | (model.column(lambda f: p[f]) >= needed)) & ~F.exists("pii_base", lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"]))

    if model.bare:
        return found.withColumn("pii_spans", F.col("pii_base"))
    more = F.transform(
        F.filter(F.when(text.rlike("[0-9@]| at |\\(at\\)|\\[at\\]|[A-Za-z0-9_-]{24}"), proposals(text)).otherwise(F.array()), accepted),
        lambda p: F.struct(p["start"].alias("start"), F.element_at(ranks, p["kind"] + 1).alias("rank"), p["end"].alias("end"), F.element_at(named, p["kind"] + 1).alias("kind")),
    )
    return found.withColumn("pii_spans", F.array_sort(F.array_distinct(F.concat(F.col("pii_base"), more))))


def fit_on(docs: DataFrame, text_col: str = "text", **options) -> Boosted:
    """The model of these documents: the table of counts, bounded by the bins in use, is all that the driver gets."""
    return fit(evidence(docs, text_col).collect(), **options)


def _listed(spans_col: str) -> Column:
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, the counts per base kind, base_sha256 and spans, one row per row of find()."""
    count = lambda kind: F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(_listed("pii_base"), 256).alias("base_sha256"), _listed("pii_spans").alias("spans"))


def redacted(docs: DataFrame, model: Boosted | None = None, text_col: str = "text") -> DataFrame:
    """docs with every found span's text replaced by its kind in brackets; overlapping spans become one, named by the
    first.  A null text stays null; other columns stay as they are, whatever their names."""
    found = find(docs.select(F.col(text_col).alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row")), model)
    merged = F.aggregate("pii_spans", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"), lambda a, s: F.when(
        (F.size(a) > 0) & (F.coalesce(F.try_element_at(a, F.lit(-1))["end"], F.lit(-1)) > s["start"]),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"), F.element_at(a, -1)["kind"].alias("kind")))),
    ).otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))))
    cut = found.withColumn("cuts", F.when(F.size("pii_spans") > 0, merged))
    before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.element_at("cuts", F.greatest(i, F.lit(1)))["end"])
    piece = lambda c, i: F.concat(F.substring("text", (before(i) + 1).cast("int"), (c["start"] - before(i)).cast("int")), F.lit("["), F.upper(c["kind"]), F.lit("]"))
    tail = F.substring("text", (F.element_at("cuts", -1)["end"] + 1).cast("int"), F.char_length("text"))
    text = F.when(F.col("cuts").isNotNull(), F.concat(F.array_join(F.transform("cuts", piece), ""), tail)).otherwise(F.col("text"))
    return cut.select("row", text.alias("text")).select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
