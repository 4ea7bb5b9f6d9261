"""Ranked lexical search: every document against every item of a stated set, the best `k` per item.

Short posting lists go term at a time: their contributions are summed into accumulators, which then count as one list
with known bounds.  Long lists go document at a time: all of an item's lists advance together over blocks of documents,
and a block is skipped when the greatest contributions of its long lists and its greatest accumulator together stay
below the item's threshold.  Inside a block that is not skipped the lists are taken by falling bound; once those to come
cannot lift a new document over the threshold, only documents that can still reach it are looked up.

Documents stay where they are: a part's postings are one stored row per document, and inverted lists are made per part
of some thousand documents.  A first pass finds thresholds: the true scores of the documents with the greatest
accumulators, whose k-th best over all parts no better document can fall below.  Which lists are short follows the counts
over all documents: from the rarest term up, as long as there is on average one accumulator a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matricula.session import stored

BEST = 50
PART = 4096  # documents whose inverted lists are made at once
BLOCK = 128  # documents that are skipped together
TERMS_AT_ONCE = 1_000_000  # (item, term) pairs of one pass over the documents
TABLE = bytes(ord(" ") if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)).lower()
POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item int, doc_id long, score long"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


@dataclass
class Search:
    """What every task needs: items as lists of term numbers and, per term, its weight and whether its list is short."""

    items: list[np.ndarray]
    weight: np.ndarray
    short: np.ndarray
    documents: int
    words: int
    best: int
    floor: np.ndarray  # per item, the score that a result has at least
    part: int = PART
    block: int = BLOCK


def _postings(batches: Iterator[pa.RecordBatch], handed) -> Iterator[pa.RecordBatch]:
    """One row per document with a term: its length and the counts of the items' terms in it."""
    number = handed.value
    for batch in batches:
        for begin in range(0, batch.num_rows, PART):
            part = batch.slice(begin, PART)
            n, terms, counts = [], [], []
            for text in part["text"].to_pylist():
                words = terms_of(text)
                found = np.fromiter((x for x in map(number.get, words) if x is not None), np.int32)
                t, c = np.unique(found, return_counts=True)
                n.append(len(words))
                terms.append(t)
                counts.append(c)
            cuts = pa.array(np.concatenate([[0], np.cumsum([len(t) for t in terms])]), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([np.zeros(0, np.int32), *x]), pa.int32())) for x in (terms, counts)]
            yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"])


def _documents_with(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(batch["terms"].flatten().to_numpy(), minlength=size)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])


class Part:
    """Inverted lists over a part's documents in ascending order: contributions by term and by document."""

    def __init__(self, search: Search, batch: pa.RecordBatch):
        self.search = search
        ids = batch["doc_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        length = batch["n"].to_numpy()
        lists = batch["terms"]
        per = lists.value_lengths().to_numpy()
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        doc = np.repeat(place, per)
        term = lists.flatten().to_numpy().astype(np.int64)
        tf = batch["counts"].flatten().to_numpy().astype(np.int64)
        m = 50 + (50 * np.repeat(length, per) * search.documents) // search.words
        value = search.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        by_term = np.lexsort((doc, term))
        self.doc, self.value, sorted_terms = doc[by_term], value[by_term], term[by_term]
        self.begin = np.searchsorted(sorted_terms, np.arange(len(search.weight) + 1))
        self.blocks = -(-len(ids) // search.block)
        self.greatest: dict[int, np.ndarray] = {}

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.begin[term], self.begin[term + 1])
        return self.doc[span], self.value[span]

    def bounds(self, term: int) -> np.ndarray:
        """The greatest contribution of a term in each block."""
        if term not in self.greatest:
            doc, value = self.list_of(term)
            out = np.zeros(self.blocks, np.int64)
            np.maximum.at(out, doc // self.search.block, value)
            self.greatest[term] = out
        return self.greatest[term]

    def accumulators(self, item: int) -> np.ndarray:
        """Sums over the short lists, per document."""
        out = np.zeros(len(self.ids), np.int64)
        for t in self.search.items[item]:
            if self.search.short[t]:
                doc, value = self.list_of(t)
                out[doc] += value
        return out

    def long_lists(self, item: int) -> list[int]:
        """The item's long lists that occur here, the greatest contribution first."""
        here = [t for t in self.search.items[item] if not self.search.short[t] and self.begin[t] < self.begin[t + 1]]
        return sorted(here, key=lambda t: (-int(self.bounds(t).max()), t))

    def complete(self, item: int, docs: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """scores of docs plus all long lists."""
        for t in self.long_lists(item):
            scores = scores + self.looked_up(t, docs)
        return scores

    def looked_up(self, term: int, docs: np.ndarray) -> np.ndarray:
        doc, value = self.list_of(term)
        at = np.minimum(np.searchsorted(doc, docs), len(doc) - 1)
        return np.where(doc[at] == docs, value[at], 0)

    def at_least(self, item: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents with a score of at least `least` (and above 0), and their scores."""
        least = max(least, 1)
        sums = self.accumulators(item)
        top = np.maximum.reduceat(sums, np.arange(0, len(sums), self.search.block))
        lists = self.long_lists(item)
        bound = top + sum((self.bounds(t) for t in lists), np.zeros(self.blocks, np.int64))
        if not (bound >= least).any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        open_ = np.repeat(bound >= least, self.search.block)[: len(sums)]
        after = np.cumsum([0, *[int(self.bounds(t).max()) for t in reversed(lists)]])[::-1]  # what the lists from k on add at most
        docs, scores = None, sums
        for k, t in enumerate(lists):
            if docs is None and after[k] < least:
                # A document in none of the lists so far cannot reach the threshold any more.
                docs = np.flatnonzero(open_ & (scores + after[k] >= least))
                scores = scores[docs]
            if docs is None:
                doc, value = self.list_of(t)
                scores[doc] += value
            else:
                scores = scores + self.looked_up(t, docs)
                keep = scores + after[k + 1] >= least
                docs, scores = docs[keep], scores[keep]
        if docs is None:
            docs = np.flatnonzero(open_)
            scores = scores[docs]
        keep = scores >= least
        return docs[keep], scores[keep]


def _parts(batches: Iterator[pa.RecordBatch], search: Search) -> Iterator[Part]:
    for batch in batches:
        for begin in range(0, batch.num_rows, search.part):
            yield Part(search, batch.slice(begin, search.part))


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _rows(found: dict[int, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    items = sorted(found)
    join = lambda k: np.concatenate([np.zeros(0, np.int64), *[found[i][k] for i in items]])
    item = np.repeat(np.array(items, np.int32), [len(found[i][0]) for i in items])
    return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(join(0)), pa.array(join(1))], names=["item", "doc_id", "score"])


def _merged(found: dict, item: int, ids: np.ndarray, scores: np.ndarray, k: int) -> None:
    if item in found:
        ids, scores = np.concatenate([found[item][0], ids]), np.concatenate([found[item][1], scores])
    at = best_of(ids, scores, k)
    found[item] = ids[at], scores[at]


def _likely(batches: Iterator[pa.RecordBatch], handed) -> Iterator[pa.RecordBatch]:
    """True scores of the documents with the greatest accumulators, the best k per item and task."""
    search: Search = handed.value
    found: dict = {}
    for part in _parts(batches, search):
        for item in range(len(search.items)):
            sums = part.accumulators(item)
            docs = np.flatnonzero(sums)
            if len(docs):
                docs = np.sort(docs[np.argsort(-sums[docs], kind="stable")[: search.best]])
                _merged(found, item, part.ids[docs], part.complete(item, docs, sums[docs]), search.best)
    yield _rows(found)


def _search(batches: Iterator[pa.RecordBatch], handed) -> Iterator[pa.RecordBatch]:
    """The best k per item and task, no document below the item's threshold."""
    search: Search = handed.value
    found: dict = {}
    for part in _parts(batches, search):
        for item in range(len(search.items)):
            least = int(search.floor[item])
            if item in found and len(found[item][1]) == search.best:
                least = max(least, int(found[item][1][-1]))
            docs, scores = part.at_least(item, least)
            if len(docs):
                _merged(found, item, part.ids[docs], scores, search.best)
    yield _rows(found)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array([sorted(set(terms_of(t))) for t in batch["text"].to_pylist()], pa.list_(pa.binary()))], names=["item_id", "terms"])


def rank(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: for each item (item_id, text) the `best` documents (doc_id, text) above 0.

    Rows of one item_id are one item with the terms of all of them.  Every document row counts; rows without a doc_id
    count in the statistics and are not returned.  Items and their terms are sent to every task, in passes of
    TERMS_AT_ONCE pairs of item and term on average."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    each = items.select("item_id", "text").mapInArrow(_item_terms, f"item_id {kind}, terms array<binary>")
    pairs = each.select("item_id", F.explode("terms").alias("term")).distinct()
    listed = stored(pairs.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")), "items")
    passes = max(1, -(-(listed.agg(F.sum(F.size("terms"))).first()[0] or 0) // TERMS_AT_ONCE))
    dealt = listed.withColumn("turn", F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(passes)))
    out = [_pass(docs, dealt.where(F.col("turn") == turn).drop("turn"), best, kind) for turn in range(passes)]
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def _pass(docs: DataFrame, listed: DataFrame, best: int, kind: str) -> DataFrame:
    spark = docs.sparkSession
    table = listed.toArrow()
    lists = table["terms"].to_pylist()
    terms = sorted({t for x in lists for t in x})
    number = {t: i for i, t in enumerate(terms)}
    handed = spark.sparkContext.broadcast(number)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    postings = stored(rows.mapInArrow(lambda b: _postings(b, handed), POSTINGS).where("n > 0"), "postings")
    total = postings.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    counted = postings.select("terms").mapInArrow(lambda b: _documents_with(b, len(terms)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(terms), np.int64)
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    asked = np.bincount([number[t] for x in lists for t in x], minlength=len(terms)).astype(np.int64)
    rarest = np.argsort(df, kind="stable")
    short = np.zeros(len(terms), bool)
    short[rarest] = np.cumsum((df * asked)[rarest]) <= total["documents"]
    weight = np.array([floor(1000 * log((2 * total["documents"] + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    search = Search([np.array([number[t] for t in x], np.int64) for x in lists], weight, short, total["documents"], max(total["words"], 1), best, np.zeros(len(lists), np.int64), PART, BLOCK)
    named = postings.where("doc_id IS NOT NULL")
    first = spark.sparkContext.broadcast(search)
    top = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    likely = named.mapInArrow(lambda b: _likely(b, first), FOUND).withColumn("rank", F.row_number().over(top)).where(F.col("rank") == best).select("item", "score").toArrow()
    search.floor[likely["item"].to_numpy()] = likely["score"].to_numpy()
    second = spark.sparkContext.broadcast(search)
    ranked = named.mapInArrow(lambda b: _search(b, second), FOUND).withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= best)
    names = spark.createDataFrame(pa.table({"item": pa.array(range(len(lists)), pa.int32()), "item_id": table["item_id"]}))
    return ranked.join(names, "item").select(F.col("item_id").cast(kind).alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
