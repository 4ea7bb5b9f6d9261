"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has the bits that are set in over half of its shingles' hashes.  Fingerprints at most `DIFFER` bits
apart are linked.  The 64 bits are cut into partitions, correlated bits together.  Each fingerprint gets a threshold per
partition, -1 (skip it) or more, that sum up to DIFFER + 1 - partitions; by the pigeonhole principle every linked
fingerprint is within the threshold in at least one partition.  The thresholds are unequal and chosen per fingerprint by
dynamic programming on candidate counts estimated from histograms of the partitions' values: a value that many
fingerprints share is skipped and paid for where the fingerprint is rare.  The number of partitions follows the number of
fingerprints, so a value's expected candidates do not grow with the input.

Every fingerprint stands under its own values; it probes the values within its thresholds.  Only connected components
are wanted, so within a value all are compared with its densest fingerprint first, in rounds while that helps large
groups, and only fingerprints that this leaves in different components are compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matricula.llm.components import components, contracted
from matricula.session import stored

BITS = 64
SEED = 42
SHINGLE = 4  # words
DIFFER = 4  # bits in which linked fingerprints may differ
SLICE = 16  # bits of a histogram; a wider partition has several, taken as independent
ROW_COST = 20.0  # a probed value costs as much as so many comparisons
LARGE = 64  # rows of a value from which further rounds and bands of distance pay
ROUNDS = 3
PART = 1000  # rows worked on at once
U = np.uint64
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle, repeats included; a text of fewer words is one shingle, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, U)
    line = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    begins = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[b:e], SEED) for b, e in zip(begins, ends[size - 1:] or ends[-1:])], U)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as an unsigned number; 0 for none."""
    places = (hashes.view(np.uint8).reshape(-1, 8) + (np.arange(8) * 256)).ravel()
    counts = np.einsum("pv,vb->pb", np.bincount(places, minlength=2048).reshape(8, 256), BYTE_BITS).ravel()
    return int(sum(1 << b for b in np.flatnonzero(2 * counts > len(hashes)).tolist()))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, PART):
            part = batch.slice(begin, PART)
            found = np.array([fingerprint(shingle_hashes(t)) for t in part["text"].to_pylist()], U)
            yield pa.RecordBatch.from_arrays([part["doc_id"].cast(pa.int64()), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def bit_matrix(fps: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones per fingerprint, lowest bit first."""
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often two bits are set together."""
    total = np.zeros((BITS, BITS))
    for batch in batches:
        x = bit_matrix(batch["fp"].to_numpy()).astype(np.float32)
        total += x.T @ x
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel().astype(np.int64))], names=["i", "j", "n"])


def correlated_groups(together: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """The bits dealt to `parts` groups of nearly equal size; each starts with the bit most correlated with the bits left
    and takes the one most correlated with its own."""
    p = together.diagonal() / max(total, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    bound = np.abs((together / max(total, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(bound, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        room = len(left) // (parts - k)
        group = [max(left, key=lambda b: (bound[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < room:
            nearest = max(left, key=lambda b: (bound[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def number_of_parts(total: int) -> int:
    """The partitions for so many fingerprints, by probed values and expected comparisons if bits were even."""

    def cost(parts: int) -> float:
        width, spare, probes = BITS / parts, DIFFER + 1 - parts, 0
        taus = [(spare // parts) + (k < spare % parts) for k in range(parts)]
        for t in taus:
            probes += sum(ball_size(int(width), d) for d in range(t + 1))
        return probes * (ROW_COST + total / 2**width)

    return min((5, 4, 3, 2), key=cost)


def ball_size(width: int, d: int) -> int:
    out = 1
    for k in range(d):
        out = out * (width - k) // (k + 1)
    return out


@dataclass(frozen=True)
class Layout:
    """Partitions as lists of bits, each cut into slices of at most SLICE bits that have a histogram."""

    parts: list[list[int]]

    def slices(self, part: int) -> list[list[int]]:
        bits = self.parts[part]
        n = -(-len(bits) // SLICE)
        return [bits[len(bits) * k // n: len(bits) * (k + 1) // n] for k in range(n)]

    def all_slices(self) -> list[list[int]]:
        return [s for p in range(len(self.parts)) for s in self.slices(p)]

    def mask(self, part: int) -> int:
        return sum(1 << b for b in self.parts[part])


def gathered(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """These bits of each fingerprint side by side."""
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(bits):
        out |= ((fps >> U(b)) & U(1)).astype(np.int64) << k
    return out


def _values(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Counts of the values of every slice, in a table of fixed size per task."""
    slices = layout.all_slices()
    counts = [np.zeros(1 << len(s), np.int64) for s in slices]
    for batch in batches:
        fps = batch["fp"].to_numpy().view(U)
        for s, bits in enumerate(slices):
            counts[s] += np.bincount(gathered(fps, bits), minlength=len(counts[s]))
    for s, c in enumerate(counts):
        v = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), s, np.int32)), pa.array(v), pa.array(c[v])], names=["slice", "value", "n"])


def at_distance(counts: np.ndarray, furthest: int) -> np.ndarray:
    """For every value the fingerprints whose value is exactly 0, 1, ... furthest bits away."""
    width = len(counts).bit_length() - 1
    around = lambda x: sum(x[np.arange(len(x)) ^ (1 << b)] for b in range(width))
    rings = [counts.astype(np.float64)]
    for d in range(1, furthest + 1):
        back = (width - d + 2) * rings[d - 2] if d > 1 else 0
        rings.append((around(rings[d - 1]) - back) / d)
    return np.stack(rings).astype(np.float32)


def expected(fps: np.ndarray, layout: Layout, rings: list[np.ndarray], total: int, part: int, furthest: int) -> np.ndarray:
    """Estimated fingerprints within 0 ... furthest bits of each one's value in a partition; slices count as independent."""
    first = sum(len(layout.slices(p)) for p in range(part))
    share = None
    for k, bits in enumerate(layout.slices(part)):
        here = rings[first + k][:, gathered(fps, bits)][: furthest + 1].astype(np.float64) / max(total, 1)
        share = here if share is None else np.stack([sum(share[a] * here[d - a] for a in range(d + 1)) for d in range(furthest + 1)])
    return share.cumsum(axis=0) * total


def thresholds(costs: list[np.ndarray], budget: int) -> np.ndarray:
    """costs[part][t + 1, row]: cost of threshold t from -1 on.  The cheapest thresholds per row that sum up to budget."""
    rows, lowest = costs[0].shape[1], -len(costs)
    span = budget - lowest + 1  # sums lowest .. budget
    best = np.full((span, rows), np.inf)
    best[0] = 0  # all partitions at -1
    picks = []
    for c in costs:
        step = np.full((len(c), span, rows), np.inf)
        for t in range(min(len(c), span)):
            step[t, t:] = best[: span - t] + c[t]
        picks.append(step.argmin(axis=0))
        best = step.min(axis=0)
    chosen, at = np.zeros((len(costs), rows), np.int64), np.full(rows, span - 1)
    for p in reversed(range(len(costs))):
        chosen[p] = picks[p][at, np.arange(rows)]
        at = at - chosen[p]
    return chosen - 1


def _probes(batches: Iterator[pa.RecordBatch], layout: Layout, handed) -> Iterator[pa.RecordBatch]:
    """part, value, fp, dense, own: a row under every own value and under every value within the threshold."""
    rings, total = handed.value
    parts = len(layout.parts)
    budget = DIFFER + 1 - parts
    furthest = min(DIFFER, budget + parts - 1)
    masks = [U(layout.mask(p)) for p in range(parts)]
    around = [[np.array([sum(1 << b for b in c) for c in combinations(bits, d)], U) for d in range(1, furthest + 1)] for bits in layout.parts]
    for batch in batches:
        for begin in range(0, batch.num_rows, PART):
            fps = batch["fp"].slice(begin, PART).to_numpy().view(U)
            near = [expected(fps, layout, rings, total, p, furthest) for p in range(parts)]
            dense = sum(x[0] for x in near).astype(np.int64)
            values = [sum(ball_size(len(layout.parts[p]), d) for d in range(t + 1)) for p in range(parts) for t in range(furthest + 1)]
            costs = [np.vstack([np.zeros(len(fps)), *[near[p][t] + ROW_COST * values[p * (furthest + 1) + t] for t in range(furthest + 1)]]) for p in range(parts)]
            taus = thresholds(costs, budget)
            for p in range(parts):
                yield _rows(p, fps & masks[p], fps, dense, True)
                for d in range(1, furthest + 1):
                    who = taus[p] >= d
                    if who.any():
                        for cut in np.array_split(np.flatnonzero(who), -(-int(who.sum()) * len(around[p][d - 1]) // 100_000)):
                            values_here = ((fps[cut] & masks[p])[:, None] ^ around[p][d - 1][None, :]).ravel()
                            yield _rows(p, values_here, np.repeat(fps[cut], len(around[p][d - 1])), np.repeat(dense[cut], len(around[p][d - 1])), False)


def _rows(part: int, value: np.ndarray, fp: np.ndarray, dense: np.ndarray, own: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), part, np.int32)), pa.array(value.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(dense), pa.array(np.full(len(fp), own))], names=["part", "value", "fp", "dense", "own"])


def apart(x: Column | str, y: Column | str) -> Column:
    """Bits in which two fingerprints differ."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return F.bit_count(x.bitwiseXOR(y))


def _named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows with the component of `fp` and of `hub`; one without a link is its own."""
    out = rows.join(names.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return out.join(names.select(F.col("node").alias("hub"), F.col("component").alias("of_hub")), "hub", "left").withColumn("of_hub", F.coalesce("of_hub", "hub"))


def links(fps: DataFrame) -> DataFrame:
    """a, b: pairs of fingerprints of fps (distinct `fp`) at most DIFFER bits apart that connect all that such pairs connect."""
    spark = fps.sparkSession
    total = fps.count()
    parts = number_of_parts(total)
    pairs = fps.mapInArrow(_together, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).toArrow()
    together = np.zeros((BITS, BITS))
    together[pairs["i"].to_numpy(), pairs["j"].to_numpy()] = pairs["n"].to_numpy()
    layout = Layout(correlated_groups(together, total, parts))
    found = fps.mapInArrow(lambda b: _values(b, layout), "slice int, value long, n long").groupBy("slice", "value").agg(F.sum("n").alias("n")).toArrow()
    rings = []
    for s, bits in enumerate(layout.all_slices()):
        here = found["slice"].to_numpy() == s
        counts = np.zeros(1 << len(bits), np.int64)
        counts[found["value"].to_numpy()[here]] = found["n"].to_numpy()[here]
        rings.append(at_distance(counts, DIFFER))
    handed = spark.sparkContext.broadcast((rings, total))
    probes = fps.mapInArrow(lambda b: _probes(b, layout, handed), "part int, value long, fp long, dense long, own boolean")
    key = ["part", "value"]
    hubs = probes.groupBy(*key).agg(F.max(F.when(F.col("own"), F.struct("dense", "fp"))).getField("fp").alias("hub"), F.count("*").alias("n"))
    met = stored(probes.join(hubs.where("hub IS NOT NULL AND n > 1"), key).select(*key, "fp", "dense", "hub", "n", apart("fp", "hub").cast("int").alias("far")), "met")
    star = stored(met.where((F.col("far") <= DIFFER) & (F.col("fp") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct(), "star")
    for _ in range(ROUNDS - 1):
        # Large values: those outside the component of the hub get a hub of their own, tested against all.
        large = _named(met.where(F.col("n") > LARGE), components(contracted(star)))
        second = large.where("component <> of_hub").groupBy(*key).agg(F.max(F.struct("dense", "fp")).getField("fp").alias("other"))
        more = stored(large.join(second, key).where((apart("fp", "other") <= DIFFER) & (F.col("fp") != F.col("other"))).select(F.col("other").alias("a"), F.col("fp").alias("b")).distinct(), "star")
        if more.isEmpty():
            break
        star = star.unionByName(more)
    rest = _named(met, components(contracted(star)))
    # A value matters only if it has a component besides its hub's.
    spread = rest.groupBy(*key).agg(F.max(F.col("component") != F.col("of_hub")).alias("open")).where("open").select(*key)
    rest = stored(rest.join(spread, key).select(*key, "fp", "component", "of_hub", "far", "n"), "open")
    # By the triangle inequality linked fingerprints are about as far from the hub: large values meet in bands of that.
    band = F.when(F.col("n") > LARGE, F.floor(F.col("far") / (DIFFER + 1)).cast("int")).otherwise(0)
    bands = F.when(F.col("n") > LARGE, F.array(band - 1, band, band + 1)).otherwise(F.array(F.lit(0)))
    x = rest.where("component <> of_hub").select(*key, F.explode(bands).alias("band"), F.col("fp").alias("a"), F.col("component").alias("of_a"))
    y = rest.select(*key, band.alias("band"), F.col("fp").alias("b"), F.col("component").alias("of_b"))
    near = x.join(y, [*key, "band"]).where((F.col("of_a") != F.col("of_b")) & (apart("a", "b") <= DIFFER))
    return star.unionByName(near.select("a", "b").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, fp (64 bits as a signed number), component_id (the smallest doc_id
    reachable by links, itself included).

    Null texts and texts without words have the fingerprint 0 and are linked like any other.  Rows of one doc_id are one
    document: different texts under one id hold their components together.  A row without an id keeps its fingerprint,
    links nothing and has no component."""
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    full = rows.where("doc_id IS NOT NULL")
    fps = stored(full.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    twice = full.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b").select("doc_id", "a")
    held = full.join(twice, "doc_id").select("a", F.col("fp").alias("b")).distinct()
    found = components(contracted(links(fps.select("fp")).unionByName(held)))
    member = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    named = member.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp", "left").select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
