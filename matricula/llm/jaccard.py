"""Near-duplicate join on word shingles with parity sketches.

A set's shingles are dealt by hash to the bands of its size class and XORed band by band.  Two sets that differ in d
shingles differ in at most d bands, so the number of unequal bands is a lower bound of the symmetric difference.  A
similarity of at least s bounds that difference by D for sets of a size class, so of K bands at least K - D are equal.
Sets therefore meet in an equal, non-empty band of their size class and are verified exactly.  K is about twice D: any
D + 1 of a set's non-empty bands, taken in an order that is the same for all sets, meet one of the other set's.  Bands
that many sets share, such as those inside a common passage, come last in that order and are seldom needed.  The order
decides the cost and not the result.  Sets with too many empty bands meet each other in their first shingles instead,
as many as the similarity allows to differ, plus one.

Equal sets are one node.  Within a band's run of equal values every set is compared with the run's hub; only sets that
this leaves in different components, and that the triangle inequality of the Jaccard distance does not separate, are
compared with each other, and those that share several runs mostly in the first of them only.  Before any set moves, the
pair's sizes and 512-bit parity sketches have to leave room for a link, and then, of large sets, sketches of as many bits
as their allowed difference asks for: the Hamming distance of two parity sketches is a lower bound of the symmetric
difference.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matricula.llm.components import components
from matricula.session import stored

STRETCH = 1.5  # ratio of a size class
OFTEN = 3  # times that a band's value stands in a run of rows to count as common there
COMMON = 200_000  # common values, most frequent first, that come last in the order; others keep the order of their hash
PART = 1000  # rows that are worked on at once
ARROW_ROWS = 2000  # rows with sets in one batch between Spark and Python: a set is some kilobytes
KEY_ROWS = 10_000  # rows of two numbers in one batch
HUB_PART = 200  # sets that meet one copy of a hub's set
SKETCH = 512  # bits of the sketch that travels with a set
LARGE = 1000  # shingles from which on a longer one travels beside it
EARLIEST = 8  # smallest keys of its runs that a set carries, so that a pair that shares several is compared in the first
SEND_IDS = 2_000_000  # ids up to which a list of them is sent to every task
U = np.uint64
CENTRE = U(0xFFF)  # the bits of a key that hold the place in its run
CENTRE_BITS = 12


@dataclass(frozen=True)
class Rule:
    """Shingles of `size` words; linked from 100 * intersection >= percent * union on."""

    size: int = 5
    percent: int = 80

    def largest(self, n: int) -> int:
        """The most shingles that a set linked with one of n, and not smaller, can have."""
        return n * 100 // self.percent

    def differ(self, a: int, b: int) -> int:
        """The largest symmetric difference of linked sets of these sizes."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def prefix(self, n: int) -> int:
        """Shingles of n of which a linked set must share one."""
        return n - -(-self.percent * n // 100) + 1


@dataclass(frozen=True)
class SizeClass:
    """Pairs whose smaller set has low..high shingles meet here; sets up to `top` take part."""

    number: int
    low: int
    high: int
    top: int
    differ: int
    bands: int


@lru_cache(maxsize=None)
def size_class(rule: Rule, number: int) -> SizeClass:
    low = 1
    for _ in range(number):
        low = max(low + 1, int(low * STRETCH))
    high = max(low + 1, int(low * STRETCH)) - 1
    differ = max(rule.differ(a, rule.largest(a)) for a in (high, max(low, high - 1)))
    bands = differ + 1
    for _ in range(20):  # room for the empty bands to expect of the smallest set
        empty = bands * exp(-low / bands)
        bands = 2 * differ + 2 + ceil(empty + 1.5 * sqrt(empty))
    return SizeClass(number, low, high, rule.largest(high), differ, bands)


def classes_of(rule: Rule, n: int) -> list[SizeClass]:
    """The classes in which a set of n shingles can meet another one; none if it cannot be linked with a different one."""
    found, number = [], 0
    while True:
        c = size_class(rule, number)
        if c.low > n:
            return found
        if n <= c.top and c.differ > 0:
            found.append(c)
        number += 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    x = x.astype(U)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lower-cased, words between ASCII white space.

    A text of fewer words, but not none, is one shingle; null and empty texts have none."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    flat: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        counts[k] = len(found)
        flat.extend(map(numbers.__getitem__, found))
    numbers.default_factory = None  # else the dictionary holds itself and its words stay until cycles are collected
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in numbers), U, len(numbers))
    words = table[np.array(flat, np.int64)] if flat else np.zeros(0, U)
    rolled = np.zeros(max(0, len(words) - size + 1), U)
    for j in range(size):
        rolled = rolled * U(0x9E3779B97F4A7C15) + mixed(words[j:j + len(rolled)] + U(j))
    rolled = mixed(rolled)
    out, end = [], 0
    for n in counts.tolist():
        begin, end = end, end + n
        if n >= size:
            out.append(np.unique(rolled[begin:end - size + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(words[begin:end].tobytes(), seed=n)], U))
        else:
            out.append(np.zeros(0, U))
    return out


def band_keys(shingles: np.ndarray, rule: Rule, common: tuple[np.ndarray, np.ndarray] | None = None, every: bool = False) -> np.ndarray:
    """The values under which a set meets others: of each class it takes part in, D + 1 of its non-empty bands.

    common: sorted values and their counts; higher counts come later.  With `every` all non-empty bands.  The lowest
    bits tell how few of the set's bands are common, so that in a run the set nearest to the others comes first."""
    keys, shared = [], 0
    for c in classes_of(rule, len(shingles)):
        band = (mixed(shingles + U(c.number)) % U(c.bands)).astype(np.int64)
        order = np.argsort(band, kind="stable")
        used, begin = np.unique(band[order], return_index=True)
        value = np.bitwise_xor.reduceat(mixed(shingles ^ U(0xA5A5A5A5))[order], begin)
        key = mixed(value + mixed(used.astype(U) + U(c.number << 32)))
        if not every and len(key) > c.differ + 1:
            count = np.zeros(len(key), np.int64)
            if common is not None and len(common[0]):
                at = np.minimum(np.searchsorted(common[0], key), len(common[0]) - 1)
                count = np.where(common[0][at] == key, common[1][at], 0)
                shared += int((count > 0).sum())
            key = key[np.lexsort((key, count))[:c.differ + 1]]
        keys.append(key)
        if c.bands - len(used) >= c.bands - c.differ:
            keys.append(mixed(shingles[:rule.prefix(len(shingles))] + U((c.number << 32) + (1 << 31))))
    every_key = np.concatenate(keys) if keys else np.zeros(0, U)
    return every_key if every else (every_key & ~CENTRE) | U(max(0, int(CENTRE) - shared))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH parity bits as 64-bit words: each shingle flips one."""
    odd = np.bincount((shingles % U(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray, rule: Rule) -> bytes:
    """Parity bits, eight for each shingle in which linked sets of this size may differ, up to the next power of two;
    empty where SKETCH bits are as many.  Halves XORed give the sketch of half as many bits."""
    bits = 1 << (8 * rule.differ(len(shingles), len(shingles)) or 1).bit_length()
    if bits <= SKETCH:
        return b""
    odd = np.bincount((shingles & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def long_sketch(wide: bytes, n: int) -> list[int]:
    """The wide sketch of a set of LARGE or more shingles at half its bits, as 64-bit words; empty for smaller sets."""
    if n < LARGE or not wide:
        return []
    words = np.frombuffer(wide, np.int64)
    return (words[: len(words) // 2] ^ words[len(words) // 2:]).tolist()


def _refined(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """a, b, may, least: whether the wide sketches of a pair leave room for a link, and how far apart it is at least."""
    for batch in batches:
        may, least = [], []
        for p, q, n in zip(batch["x_wide"], batch["y_wide"], (batch["x_n"].to_numpy() + batch["y_n"].to_numpy()).tolist(), strict=True):
            x, y = np.frombuffer(p.as_buffer(), np.uint8), np.frombuffer(q.as_buffer(), np.uint8)
            while len(x) != len(y):
                x, y = (x[: len(x) // 2] ^ x[len(x) // 2:], y) if len(x) > len(y) else (x, y[: len(y) // 2] ^ y[len(y) // 2:])
            d = int(np.bitwise_count(x ^ y).sum())
            may.append(d * (100 + rule.percent) <= n * (100 - rule.percent))
            least.append(2 * d / (n + d))
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(may, pa.bool_()), pa.array(least, pa.float64())], names=["a", "b", "may", "least"])


def _often(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Band values that stand OFTEN times in PART rows, with how often."""
    for batch in batches:
        for begin in range(0, batch.num_rows, PART):
            sets = shingle_sets(batch.slice(begin, PART)["text"].to_pylist(), rule.size)
            key, n = np.unique(np.concatenate([np.zeros(0, U), *[band_keys(s, rule, every=True) for s in sets]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key[n >= OFTEN].view(np.int64)), pa.array(n[n >= OFTEN].astype(np.int64))], names=["key", "n"])


def _describe(batches: Iterator[pa.RecordBatch], rule: Rule, common: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, PART):
            part = batch.slice(begin, PART)
            sets = shingle_sets(part["text"].to_pylist(), rule.size)
            n = np.array([len(s) for s in sets], np.int64)
            low = np.array([np.bitwise_xor.reduce(mixed(s)) if len(s) else 0 for s in sets], U).view(np.int64)
            high = np.array([mixed(s + U(7)).sum(dtype=U) if len(s) else 0 for s in sets], U).view(np.int64)
            keys = [band_keys(s, rule, common).view(np.int64) for s in sets]
            cuts = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            wide = [wide_sketch(s, rule) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"].cast(pa.int64()), pa.array(n), pa.array(low), pa.array(high), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int64())), pa.array([sketch(s).tolist() for s in sets], pa.list_(pa.int64())), pa.array([long_sketch(w, k) for w, k in zip(wide, n.tolist(), strict=True)], pa.list_(pa.int64())), pa.array(wide, pa.binary())],
                names=["doc_id", "n", "low", "high", "keys", "sketch", "long", "wide"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted (key, rep) rows the runs of equal keys with two or more sets: key, hub (the run's first), rep.

    The first and the last run of a partition are marked, whatever their length: a range cut may have split them.
    Between batches only the open run's key and hub are kept."""

    def rows(key, hub, rep, edge):
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(hub), pa.array(rep), pa.array(np.full(len(key), edge))], names=["key", "hub", "rep", "edge"])

    last_key = hub = None
    first = None
    pending: tuple | None = None  # the open run's first row, if nothing of it is written yet
    for batch in batches:
        key, rep = batch["key"].to_numpy() >> CENTRE_BITS, batch["rep"].to_numpy()
        if not len(key):
            continue
        if first is None:
            first = key[0]
        new = np.r_[key[0] != last_key if last_key is not None else True, key[1:] != key[:-1]]
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        hubs = np.where(run >= 0, rep[start[np.maximum(run, 0)]] if len(start) else hub, hub if hub is not None else 0)
        length = np.bincount(run[run >= 0], minlength=len(start))
        carried = run < 0
        if carried.any() and pending is not None:
            yield rows([pending[0]], [pending[1]], [pending[1]], pending[0] == first)
            pending = None
        elif len(start) and pending is not None and not carried.any():
            if pending[0] == first:
                yield rows([pending[0]], [pending[1]], [pending[1]], True)
            pending = None
        keep = carried | (length[np.maximum(run, 0)] > 1) if len(start) else carried
        tail = len(start) > 0 and length[-1] == 1
        single_first = (key == first) & ~keep
        if tail:
            single_first[-1] = False
        keep = keep | single_first
        if keep.any():
            for edge in (True, False):
                chosen = keep & ((key == first) == edge)
                if chosen.any():
                    yield rows(key[chosen], hubs[chosen], rep[chosen], edge)
        if tail:
            pending = (key[-1], rep[-1])
        last_key, hub = key[-1], hubs[-1]
    if pending is not None:
        yield rows([pending[0]], [pending[1]], [pending[1]], True)
    elif last_key is not None:
        yield rows([last_key], [hub], [hub], True)


def _needed(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """The set of each text once for every place where it is needed: hub, salt, own (it is the hub's), rep, set."""
    for batch in batches:
        for begin in range(0, batch.num_rows, PART):
            part = batch.slice(begin, PART)
            sets = shingle_sets(part["text"].to_pylist(), rule.size)
            which = np.repeat(np.arange(len(sets)), part["places"].value_lengths().to_numpy())
            # Another text of the same id may be empty; it is similar to nothing.
            keep = np.array([len(x) > 0 for x in sets], bool)[which]
            places, which = part["places"].flatten().filter(pa.array(keep)), which[keep]
            ids = part["doc_id"].cast(pa.int64()).take(pa.array(which, pa.int64()))
            for cut in range(0, len(which), ARROW_ROWS):
                here = which[cut:cut + ARROW_ROWS].tolist()
                field = lambda name: places.field(name).slice(cut, len(here))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([field("hub"), field("salt"), field("own"), ids.slice(cut, len(here)), pa.array([sets[i].tobytes() for i in here], pa.binary())], names=["hub", "salt", "own", "rep", "set"])


def _against_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (hub, salt), the hub's sets first: a, b, common, n_a, n_b of the hub with each other set."""
    key, hubs = None, []
    for batch in batches:
        a, b, common, n_a, n_b = [], [], [], [], []
        for hub, salt, own, rep, data in zip(*(batch[c].to_pylist() for c in ("hub", "salt", "own", "rep")), batch["set"], strict=True):
            if (hub, salt) != key:
                key, hubs = (hub, salt), []
            y = np.frombuffer(data.as_buffer(), U)
            if own:
                if not any(np.array_equal(x, y) for x in hubs):
                    hubs.append(y.copy())
                continue
            for x in hubs:
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                a.append(hub)
                b.append(rep)
                common.append(int((large[at] == small).sum()))
                n_a.append(len(x))
                n_b.append(len(y))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, common, n_a, n_b)], names=["a", "b", "common", "n_a", "n_b"])


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Batches of so many rows between Spark and Python, as long as the block runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _sent(ids: DataFrame) -> DataFrame:
    """ids to be sent to every task if there are up to SEND_IDS; more are joined by a shuffle."""
    few = ids.limit(SEND_IDS + 1).count() <= SEND_IDS
    return F.broadcast(ids) if few else ids


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs with the columns of ids (doc_id, ...)."""
    return docs.join(_sent(ids), "doc_id")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id is not in ids (doc_id), those without an id as well; texts do not move for few ids."""
    return docs.join(_sent(ids), "doc_id", "left_anti")


def _verified(docs: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """pairs (a, b) with whether they are linked and the least and greatest Jaccard distance, from the whole texts.

    A doc_id with several texts counts with each of them.  Every a is met by the sets of its pairs, HUB_PART of them at a
    time, so its own set moves once for so many; nothing but sets of such pairs moves."""
    spark = docs.sparkSession
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_PART).cast("int").alias("parts"))
    place = lambda doc, salt, own: [F.col(doc).alias("doc_id"), F.struct(F.col("a").alias("hub"), salt.cast("int").alias("salt"), F.lit(own).alias("own")).alias("place")]
    members = pairs.join(parts, "a").select(*place("b", F.pmod(F.xxhash64("b"), "parts"), False))
    hubs = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")).select(*place("a", F.col("salt"), True))
    needs = stored(members.unionByName(hubs).groupBy("doc_id").agg(F.collect_list("place").alias("places")), "needs")
    with arrow_rows(spark, ARROW_ROWS):
        sets = _texts_of(docs, needs).select("doc_id", "text", "places").mapInArrow(lambda b: _needed(b, rule), "hub long, salt int, own boolean, rep long, set binary")
        dealt = sets.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "hub", "salt").sortWithinPartitions("hub", "salt", F.desc("own"))
        found = dealt.mapInArrow(_against_hub, "a long, b long, common long, n_a long, n_b long")
        far = 1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))
        return stored(found.groupBy("a", "b").agg(F.max(_linked(rule)).alias("linked"), F.min(far).alias("least"), F.max(far).alias("most")), "verified")


def _finer(pairs: DataFrame, wide: DataFrame, rule: Rule) -> DataFrame:
    """a, b, may, least: pairs of large sets judged by their wide sketches; of others nothing more is known."""
    x, y = (wide.select(F.col("rep").alias(k), F.col("n").alias(f"{v}_n"), F.col("wide").alias(f"{v}_wide")) for k, v in (("a", "x"), ("b", "y")))
    with arrow_rows(pairs.sparkSession, ARROW_ROWS):
        judged = stored(pairs.join(x, "a").join(y, "b").mapInArrow(lambda b: _refined(b, rule), "a long, b long, may boolean, least double"), "finer")
    rest = pairs.join(judged.select("a", "b"), ["a", "b"], "left_anti")
    return judged.unionByName(rest.select("a", "b", F.lit(True).alias("may"), F.lit(0.0).alias("least")))


def _linked(rule: Rule):
    return F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * rule.percent


def _differing_bits():
    return sum((F.bit_count(F.col(f"x_s{i}").bitwiseXOR(F.col(f"y_s{i}"))) for i in range(1, SKETCH // 64)), F.bit_count(F.col("x_s0").bitwiseXOR(F.col("y_s0"))))


def _long_bits():
    """Unequal bits of the long sketches of x and y, the longer one folded once; 0 where they cannot be compared."""
    half = lambda a: F.zip_with(F.slice(a, F.lit(1), (F.size(a) / 2).cast("int")), F.slice(a, (F.size(a) / 2).cast("int") + 1, (F.size(a) / 2).cast("int")), lambda p, q: p.bitwiseXOR(q))
    x, y = F.col("x_long"), F.col("y_long")
    x, y = F.when(F.size(x) == 2 * F.size(y), half(x)).otherwise(x), F.when(F.size(y) == 2 * F.size(x), half(y)).otherwise(y)
    unequal = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda a, b: a + b)
    comparable = (F.size("x_long") > 0) & (F.size("y_long") > 0) & (F.size("x_long") <= 2 * F.size("y_long")) & (F.size("y_long") <= 2 * F.size("x_long"))
    return F.when(comparable, unequal).otherwise(0)


def _may_link(rule: Rule):
    """Whether the sizes and sketches of x and y leave room for a link; ids with several texts are not judged by them."""
    sizes = (F.col("x_high") * 100 >= F.col("y_low") * rule.percent) & (F.col("y_high") * 100 >= F.col("x_low") * rule.percent)
    near = _differing_bits() * (100 + rule.percent) <= (F.col("x_low") + F.col("y_low")) * (100 - rule.percent)
    long_near = _long_bits() * (100 + rule.percent) <= (F.col("x_low") + F.col("y_low")) * (100 - rule.percent)
    return (F.col("x_texts") + F.col("y_texts") > 2) | (sizes & near & long_near)


def _at_least_far():
    """A lower bound of the Jaccard distance of x and y: d different shingles of n_x + n_y give 2 d / (n_x + n_y + d)."""
    d = F.greatest(_differing_bits(), _long_bits(), F.abs(F.col("x_low") - F.col("y_low")))
    return F.when(F.col("x_texts") + F.col("y_texts") > 2, 0.0).otherwise(2 * d / (F.col("x_low") + F.col("y_low") + d))


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """One row per row of docs (doc_id, text): doc_id, n_shingles, class_id, component_id.

    class_id is the smallest doc_id with the same set, component_id the smallest one reachable by links.  Null and empty
    texts have no shingles and are linked with nothing; a row without an id keeps its counts and has no class or
    component; rows of one doc_id are one document, so different texts under one id hold their components together."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with arrow_rows(spark, ARROW_ROWS):
        often = rows.mapInArrow(lambda b: _often(b, rule), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(COMMON).toArrow()
        value = often["key"].to_numpy().view(U)
        by_value = np.argsort(value)
        handed = spark.sparkContext.broadcast((value[by_value], often["n"].to_numpy()[by_value]))
        described = stored(rows.mapInArrow(lambda b: _describe(b, rule, handed.value), "doc_id long, n long, low long, high long, keys array<long>, sketch array<long>, long array<long>, wide binary"), "shingles")
    full = described.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    same = ["n", "low", "high"]
    names = stored(full.groupBy(*same).agg(F.min("doc_id").alias("class_id")), "classes")
    # The rows that stand for their classes; their keys do not move before they are dealt.
    own = _texts_of(full, names.select(F.col("class_id").alias("doc_id")).distinct())
    outline = stored(own.groupBy(F.col("doc_id").alias("rep")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count_distinct("low").alias("texts"), F.first(F.struct("sketch", "long", "wide")).alias("own")), "outline")
    # Ids with several texts are not judged by sketches.
    wide = outline.where((F.col("texts") == 1) & (F.octet_length("own.wide") > 0)).select("rep", F.col("low").alias("n"), F.col("own.wide").alias("wide"))
    outline = outline.select("rep", "low", "high", "texts", F.col("own.sketch").alias("sketch"), F.col("own.long").alias("long")).select("rep", "low", "high", "texts", "long", *[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH // 64)])
    pairs_of_keys = own.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs_of_keys.repartitionByRange(parts, "key", "rep").sortWithinPartitions("key", "rep")
    with arrow_rows(spark, KEY_ROWS):
        runs = stored(dealt.mapInArrow(_runs, "key long, hub long, rep long, edge boolean"), "runs")
    # A run that range cuts have split gets the smallest of its parts' first sets.
    cut = runs.where("edge").groupBy("key").agg(F.min("hub").alias("first"))
    whole = runs.join(cut, "key", "left").select("key", F.coalesce("first", "hub").alias("hub"), "rep").where(F.col("hub") != F.col("rep")).distinct()
    runs = stored(whole, "runs")
    # Sizes and sketches refuse most pairs before any set moves; for those the distance is bounded from below.
    met = runs.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    met = met.join(outline.select(*[F.col(c).alias(f"x_{c}") for c in outline.columns]), F.col("a") == F.col("x_rep")).join(outline.select(*[F.col(c).alias(f"y_{c}") for c in outline.columns]), F.col("b") == F.col("y_rep"))
    met = stored(met.select("a", "b", _may_link(rule).alias("may"), _at_least_far().alias("least")), "met")
    finer = _finer(met.where("may").select("a", "b"), wide, rule)
    verified = _verified(rows, finer.where("may").select("a", "b"), rule)
    links = verified.where("linked").select("a", "b")
    first = components(links)

    # Sets of one run in different components, unless their distances from the hub keep them apart.
    tested = met.select("a", "b", F.col("least").alias("rough")).join(finer.select("a", "b", "least"), ["a", "b"], "left").join(verified.select("a", "b", F.col("least").alias("exact"), "most"), ["a", "b"], "left")
    tested = tested.select(F.col("a").alias("hub"), F.col("b").alias("rep"), F.coalesce("exact", F.greatest("rough", "least")).alias("least"), F.coalesce("most", F.lit(1.0)).alias("most"))
    named = first.select(F.col("node").alias("rep"), "component")
    members = runs.join(tested, ["hub", "rep"]).join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    hubs = first.select(F.col("node").alias("hub"), F.col("component").alias("of_hub"))
    loose = members.join(hubs, "hub", "left").withColumn("of_hub", F.coalesce("of_hub", "hub"))
    room = (100 - rule.percent) / 100 + 1e-9
    # A component's sets in a run matter only if the run has another component besides the hub's that lies in reach.
    # Runs of the same hub and the same sets say the same: one of them stays.
    runs_alike = loose.groupBy("key").agg(
        F.count(F.when(F.col("component") != F.col("of_hub"), 1)).alias("others"), F.min("hub").alias("hub"), F.count("*").alias("sets"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("p"), F.sum(F.xxhash64("rep", F.lit(2)).cast("decimal(20,0)")).alias("q"))
    spread = runs_alike.where(F.col("others") > 0).groupBy("hub", "sets", "p", "q").agg(F.min("key").alias("key")).select("key")
    kept = stored(loose.join(spread, "key").select("key", "rep", "component", "of_hub", "least", "most"), "loose")
    # A set has at most as many keys as bands, so the list is no longer than its text.
    earliest = kept.groupBy("rep").agg(F.slice(F.sort_array(F.collect_list("key")), 1, EARLIEST).alias("earliest"))
    rest = kept.join(outline.join(earliest, "rep"), "rep")
    x = rest.where(F.col("component") != F.col("of_hub")).select("key", *[F.col(c).alias(f"x_{c}") for c in rest.columns if c != "key"])
    y = rest.select("key", *[F.col(c).alias(f"y_{c}") for c in rest.columns if c != "key"])
    once = (F.col("y_component") == F.col("y_of_hub")) | (F.col("x_rep") < F.col("y_rep"))  # pairs outside the hub's component stand in both orders
    # The sets that share a smaller key are compared there; the smallest shared one never has another before it.
    earlier = F.coalesce(F.array_min(F.array_intersect("x_earliest", "y_earliest")) < F.col("key"), F.lit(False))
    reach = once & (F.col("x_component") != F.col("y_component")) & (F.col("x_least") - F.col("y_most") <= room) & (F.col("y_least") - F.col("x_most") <= room)
    near = x.join(y, "key").where(reach & _may_link(rule) & ~earlier).select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b")).distinct()
    found = _verified(rows, _finer(stored(near, "near"), wide, rule).where("may").select("a", "b"), rule).where("linked").select("a", "b")
    # Several texts under one id: their classes belong together.
    held = full.join(names, same).where(F.col("class_id") != F.col("doc_id")).select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    twice = held.join(names.select(F.col("class_id").alias("b")), "b", "left_semi").select("a", "b")
    final = components(links.unionByName(found).unionByName(twice)).select(F.col("node").alias("class_id"), F.col("component").alias("component_id"))
    judged = described.select("doc_id", "n", "low", "high").join(names, same, "left").join(final, "class_id", "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return judged.select("doc_id", F.col("n").alias("n_shingles"), class_id.alias("class_id"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "class_id", "doc_id")).alias("component_id"))
