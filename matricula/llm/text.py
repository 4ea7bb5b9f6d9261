"""Column helpers shared by the operators: words, matched spans, letting a name stand for an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that end a word once A-Z are lower-cased: all ASCII but digits and a-z.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = 64


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; a text of ASCII alone takes the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_line(text: Column) -> Column:
    """The words of a text joined by one space each; null gives the empty string."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK, " "))


def words(text: Column) -> Column:
    """The words of a text as an array; null gives an empty array."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def starts(lengths: Column) -> Column:
    """For lengths of pieces laid end to end, the place where each begins.

    Sums are kept per run of 64 pieces, so no element looks further back than one run."""

    def within(xs: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(xs) - 1) / RUN).cast("int"))),
            lambda b: F.aggregate(F.slice(xs, b * RUN + 1, RUN), F.lit(0).cast("long"), lambda a, x: a + x),
        )
        before = F.aggregate(runs, F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
        return let(before, lambda done: F.transform(xs, lambda x, i: F.element_at(done, F.floor(i / RUN).cast("int") + 1) + F.aggregate(F.slice(xs, F.floor(i / RUN).cast("int") * RUN + 1, i % RUN), F.lit(0).cast("long"), lambda a, y: a + y)))

    return let(lengths, within)


def spans(text: Column, pattern: Column | str) -> Column:
    """Leftmost non-overlapping matches as an array of struct<start long, end long, match string>, in code points.

    The text between matches and the matches alternate, so their lengths give every place."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    kind = "array<struct<start:bigint,end:bigint,match:string>>"

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = let(gaps, lambda g: F.transform(found, lambda m, i: (F.char_length(F.element_at(g, i + 1)) + F.char_length(m)).cast("long")))
        return let(
            F.struct(steps.alias("steps"), starts(steps).alias("begins")),
            lambda s: F.transform(found, lambda m, i: F.struct(
                (F.element_at(s["begins"], i + 1) + F.element_at(s["steps"], i + 1) - F.char_length(m)).alias("start"),
                (F.element_at(s["begins"], i + 1) + F.element_at(s["steps"], i + 1)).alias("end"),
                m.alias("match"),
            )),
        )

    none = F.array().cast(kind)
    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))
