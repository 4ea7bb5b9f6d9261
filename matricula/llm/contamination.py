"""Benchmark decontamination by a positional inverted index.

The index holds postings of training tokens: term, row, place, and the words around the place.  Which terms get a
posting list is decided by the test set: of each window of test words the terms that are rarest over the whole corpus,
as many as a near-copy cannot do without.  A window occurs where its rarest term's list, shifted by the term's offset, agrees with every other term of the window;
the words around each posting let all these intersections happen where the posting lies.  Lists are stored once in the
shared folder and answer exact phrase and proximity queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matricula.llm.text import words
from matricula.session import stored

WINDOW = 10
SHARE = 0.8  # of a window's different words, for a proximity match
# The terms with posting lists come from the test set; up to this many they are sent to every task, beyond it training
# tokens are dealt by term and joined there.
BROADCAST_TERMS = 200_000


def windows(benchmark: DataFrame, length: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the test texts: window (its words), items (sorted distinct ids as strings).

    A text of fewer words than length, but not none, is one window; null and empty texts have none."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    each = items.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (length - 1))), lambda i: F.slice(F.col("w"), i, length),
    )).alias("window"))
    return each.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _tokens(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("w"))


def anchors(tests: DataFrame, docs: DataFrame, text_col: str = "text", share: float = SHARE) -> DataFrame:
    """windows() with n, term, offset and rank: each window's rarest terms over all documents (equals by the alphabet),
    from rank 1, with their first places in the window.

    One more than the different words that a proximity match may lack: at least one of them stands in every match."""
    terms = tests.select(F.explode("window").alias("term")).distinct()
    seen = docs.select(F.explode_outer(words(F.col(text_col))).alias("term")).join(_bounded(terms), "term").groupBy("term").agg(F.count("*").alias("n"))
    counts = terms.join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))
    each = tests.select("window", "items", F.explode(F.array_distinct("window")).alias("term")).join(counts, "term")
    rarest = each.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("n", "term"))).alias("terms"), F.first("items").alias("items"))
    needed = F.size("terms") - F.ceil(F.lit(share) * F.size("terms")).cast("int") + 1
    chosen = rarest.select("window", "items", F.posexplode(F.slice("terms", F.lit(1), needed)).alias("place", "best"))
    return chosen.select("window", "items", F.col("best.n").alias("n"), F.col("best.term").alias("term"), (F.array_position("window", F.col("best.term")) - 1).cast("int").alias("offset"), (F.col("place") + 1).alias("rank"))


def _bounded(terms: DataFrame) -> DataFrame:
    """terms, marked for sending to every task if there are at most BROADCAST_TERMS."""
    return F.broadcast(terms) if terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else terms


def postings(docs: DataFrame, terms: DataFrame, reach: int = WINDOW - 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index for the given terms: term, doc_id, place (words from 0), around (the words from reach before to
    reach after, cut at the text's ends) and at (how many of them come before)."""
    tokens = _tokens(docs, id_col, text_col)
    bounded = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    around = F.slice("w", F.greatest(F.lit(1), F.col("place") + 1 - reach), 2 * reach + 1 - F.greatest(F.lit(0), reach - F.col("place")))
    if bounded:
        # The words stay a reference until the join has let a token pass; only then is the neighbourhood cut out.
        placed = tokens.select("doc_id", "w", F.posexplode_outer("w").alias("place", "term")).join(F.broadcast(terms), "term")
        rows = placed.select("term", "doc_id", "place", around.alias("around"), F.least(F.lit(reach), F.col("place")).alias("at"))
    else:
        cut = F.transform("w", lambda t, i: F.struct(i.alias("place"), t.alias("term"), F.slice(F.col("w"), F.greatest(F.lit(1), i + 1 - reach), 2 * reach + 1 - F.greatest(F.lit(0), reach - i)).alias("around")))
        rows = tokens.select("doc_id", F.inline(cut)).join(terms, "term").select("term", "doc_id", "place", "around", F.least(F.lit(reach), F.col("place")).alias("at"))
    return stored(rows, "postings")


def phrase_matches(index: DataFrame, tests: DataFrame) -> DataFrame:
    """Places where a window stands word for word: doc_id, start, length, window's items."""
    size = F.size("window")
    first = F.col("at") - F.col("offset") + 1
    whole = (first >= 1) & (F.slice("around", F.greatest(F.lit(1), first), size) == F.col("window"))
    return index.join(tests.where("rank = 1"), "term").where(whole).select("doc_id", (F.col("place") - F.col("offset")).alias("start"), size.alias("length"), "items")


def proximity_matches(index: DataFrame, tests: DataFrame, share: float = SHARE) -> DataFrame:
    """Places of a window's rarest terms around which at least that share of the window's different words stand, in any
    order: doc_id, place, length, items.  tests: anchors() for no greater share.

    No stretch of as many words as the window that holds that share is missed."""
    different = F.array_distinct("window")
    near = F.size(F.array_intersect(different, F.col("around"))) >= F.lit(share) * F.size(different)
    return index.join(tests, "term").where(near).select("doc_id", "place", F.size("window").alias("length"), "items")


def find(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Exact and proximity matches of benchmark windows in docs."""
    tests = stored(anchors(windows(benchmark, length), docs), "anchors")
    index = postings(docs, tests.where("n > 0").select("term").distinct(), length - 1)
    return phrase_matches(index, tests), proximity_matches(index, tests)


def judge(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near.

    Rows of one doc_id share their hits (places of equal texts fall together; of different texts they add up), a row
    without an id or words has none.  n_near counts the places of proximity matches, those of whole windows included.  Matches are far fewer than tokens; they are
    cut to distinct places before they are brought together per document."""
    exact, near = find(docs, benchmark, length)
    # Touching or overlapping runs of hit words: a word is new if no earlier run reaches it.
    runs = exact.groupBy("doc_id", "start").agg(F.max("length").alias("length"))
    order = Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    fresh = runs.withColumn("covered", F.coalesce(F.max(end).over(order), F.lit(0)))
    hit = fresh.groupBy("doc_id").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "covered"))).cast("long").alias("n_hit"))
    items = exact.select("doc_id", F.explode("items").alias("item")).groupBy("doc_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    # Written, so that the join of postings and windows is done once and its size is known.
    close = stored(near.groupBy("doc_id").agg(F.countDistinct("place").alias("n_near")), "near")
    found = hit.join(items, "doc_id", "left").join(close, "doc_id", "full")
    counted = docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return counted.join(found, "doc_id", "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, near_places: int | None = None) -> DataFrame:
    """docs without the rows that hold a whole window of the benchmark; their columns as they were.

    With near_places rows with proximity matches at that many places or more go as well, so that a passage is caught in
    which every window has a word changed; a place is one word, and such a passage has several for each of its windows.
    Rows without an id are judged too: they carry a key of their own while they are searched."""
    row = F.struct(*[docs[c] for c in docs.columns])
    keyed = docs.select(F.sha2(F.to_json(row), 256).alias("doc_id"), "text", row.alias("row"))
    exact, near = find(keyed.select("doc_id", "text"), benchmark, length)
    found = exact.select("doc_id")
    if near_places is not None:
        found = found.unionByName(near.groupBy("doc_id").agg(F.countDistinct("place").alias("n")).where(F.col("n") >= near_places).select("doc_id"))
    return keyed.join(found.distinct(), "doc_id", "left_anti").select("row.*")
