"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; the axis and sign of
its largest coordinate is its bucket.  Every vector is in one bucket of each table.  A query looks into several buckets
per table, those of its largest coordinates first, and what it finds is ranked by exact distance.  Equal vectors are
one member of the index that carries the smallest ids, as many as an answer can use.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matricula.session import stored

K = 10
TABLES = 5
PROBES = 20
SEED = 20
BLOCK = 4_000_000  # numbers in one block of differences
LARGEST = 1e140  # beyond it, or below its inverse, squares of components leave the doubles' range or lose digits
PART = 1 << 19  # numbers in the members of one part of a bucket
ASKED = 1 << 21  # numbers in one block of a bucket's queries


def rotations(width: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Signs of three rounds per table."""
    return np.random.default_rng([seed, width]).choice(np.array([-1.0, 1.0], np.float32), (tables, 3, width))


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; its width is a power of two."""
    n, width, half = *rows.shape, 1
    while half < width:
        pairs = rows.reshape(n, width // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, width)
        half *= 2
    return rows


def rotated(vectors: np.ndarray, table: int, tables: int) -> np.ndarray:
    width = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    rows = np.zeros((len(vectors), width), np.float32)
    scaled = vectors.astype(np.float64)
    # A norm outside the squares' range would be 0 or infinite: those rows are first divided by their largest component.
    largest = np.abs(scaled).max(1, initial=0, keepdims=True)
    scaled = np.divide(scaled, largest, out=scaled.copy(), where=(largest > LARGEST) | (largest < 1 / LARGEST))
    rows[:, :vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    for signs in rotations(width, tables)[table]:
        rows = hadamard(rows * signs) / math.sqrt(width)
    return rows


def buckets(turned: np.ndarray, probes: int) -> np.ndarray:
    """The signed axes nearest to each row, nearest first: 2 * axis + (1 if negative)."""
    sides = np.stack([turned, -turned], 2).reshape(len(turned), -1)
    probes = min(probes, sides.shape[1])
    best = np.argpartition(-sides, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(best, np.argsort(-np.take_along_axis(sides, best, 1), axis=1, kind="stable"), 1)


def valid(vector: Column) -> Column:
    """Vectors that take part: not null, no null or non-finite component, not all zero."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(as_double, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors laid end to end in double precision, and their widths."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.diff(column.offsets.to_numpy())


def _entries(batches: Iterator[pa.RecordBatch], tables: int, probes: int, name: str, only: int | None) -> Iterator[pa.RecordBatch]:
    """(table, width, bucket, name, vector) for each row, table and probed bucket."""
    for batch in batches:
        flat, widths = _matrix(batch["vector"])
        begins = np.cumsum(widths) - widths
        for width in np.unique(widths):
            rows = np.flatnonzero(widths == width)
            block = flat[begins[rows][:, None] + np.arange(width)]
            for table in range(tables) if only is None else [only]:
                places = buckets(rotated(block, table, tables), probes)
                take = np.repeat(rows, places.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(take), table, np.int32)), pa.array(np.full(len(take), width, np.int32)), pa.array(places.ravel().astype(np.int32)), batch[name].take(pa.array(take)), batch["vector"].take(pa.array(take))],
                    names=["table", "width", "bucket", name, "vector"])


def index(rows: DataFrame, k: int = K) -> DataFrame:
    """Different vectors with the k + 1 smallest ids that have them: ids, vector.

    Only that many rows per vector ever leave a task (the rank is cut before the shuffle), however many copies there are."""
    seen = rows.select("vec_id", "vector").withColumn("code", F.xxhash64("vector")).distinct()
    few = seen.withColumn("rank", F.row_number().over(Window.partitionBy("code", "vector").orderBy("vec_id"))).where(F.col("rank") <= k + 1)
    return few.groupBy("code", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select("ids", "vector")


def distances(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row of q to every row of m, also where squares leave the range of doubles.

    Infinite only if the distance itself, or a difference of components, is beyond the largest double."""
    with np.errstate(over="ignore", under="ignore"):
        gap = q[:, None, :] - m[None]
        out = np.sqrt((gap ** 2).sum(2))
        odd = np.nonzero((out > LARGEST) | (out < 1 / LARGEST))
        if len(odd[0]):
            part = np.abs(gap[odd])
            largest = part.max(1, initial=0)
            fine = (largest > 0) & np.isfinite(largest)
            unit = np.divide(part, largest[:, None], out=np.zeros_like(part), where=fine[:, None])
            out[odd] = np.where(fine, largest * np.sqrt((unit ** 2).sum(1)), largest)
    return out


def _rank(queries: pa.Table, members: pa.Table, k: int) -> pa.Table:
    """The k nearest ids of each query among the members of one bucket."""
    q_flat, q_width = _matrix(queries["vector"].combine_chunks())
    m_flat, _ = _matrix(members["vector"].combine_chunks())
    width = int(q_width[0])
    q, m = q_flat.reshape(-1, width), m_flat.reshape(-1, width)
    ids = members["ids"].combine_chunks()
    flat_ids, counts = ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy())
    first = np.cumsum(counts) - counts
    q_ids = queries["query_id"].to_numpy()
    out_q, out_v, out_s = [], [], []
    step = max(1, BLOCK // max(1, width * len(m)))
    for a in range(0, len(q), step):
        gaps = distances(q[a:a + step], m) if len(m) * width <= BLOCK else np.concatenate(
            [distances(q[a:a + step], m[b:b + BLOCK // width]) for b in range(0, len(m), BLOCK // width)], 1)
        for row, distance in enumerate(gaps):
            near = np.flatnonzero(distance <= np.partition(distance, k)[k]) if len(distance) > k + 1 else np.arange(len(distance))
            member = np.repeat(near, counts[near])
            inside = np.arange(len(member)) - np.repeat(np.cumsum(counts[near]) - counts[near], counts[near])
            vec, score = flat_ids[first[member] + inside], distance[member]
            other = vec != q_ids[a + row]
            vec, score = vec[other], score[other]
            best = np.lexsort((vec, score))[:k]
            out_q.append(np.full(len(best), q_ids[a + row]))
            out_v.append(vec[best])
            out_s.append(score[best])
    joined = [np.concatenate(x) if x else np.zeros(0) for x in (out_q, out_v, out_s)]
    return pa.table({"query_id": pa.array(joined[0].astype(np.int64)), "vec_id": pa.array(joined[1].astype(np.int64)), "score": pa.array(joined[2].astype(np.float64))})


def _sizes(batches: Iterator[pa.RecordBatch], tables: int, probes: int, only: int | None) -> Iterator[pa.RecordBatch]:
    """How many rows of a batch are in each (table, width, bucket)."""
    for batch in batches:
        flat, widths = _matrix(batch["vector"])
        begins = np.cumsum(widths) - widths
        for width in np.unique(widths):
            block = flat[begins[np.flatnonzero(widths == width)][:, None] + np.arange(width)]
            for table in range(tables) if only is None else [only]:
                places, n = np.unique(buckets(rotated(block, table, tables), probes), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), table, np.int32)), pa.array(np.full(len(n), width, np.int32)), pa.array(places.astype(np.int32)), pa.array(n.astype(np.int64))],
                    names=["table", "width", "bucket", "n"])


KEYS = ["table", "width", "bucket", "part", "block"]


def _dealt(members: DataFrame, queries: DataFrame, tables: int, probes: int, only: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Entries of queries and members with KEYS, by which they meet.

    A bucket's members are dealt to parts and its queries to blocks, as many as its counts ask for, so that no group
    grows with the input; every part meets every block.  Buckets without a query or without a member are left out."""
    count = lambda rows, n, name: rows.select("vector").mapInArrow(lambda b: _sizes(b, tables, n, only), "table int, width int, bucket int, n long").groupBy("table", "width", "bucket").agg(F.sum("n").alias(name))
    pieces = lambda n, most: F.ceil(F.col(n) * F.col("width") / F.lit(most))
    sizes = count(members, 1, "held").join(count(queries, probes, "asked"), ["table", "width", "bucket"])
    sizes = stored(sizes.select("table", "width", "bucket", pieces("held", PART).alias("parts"), pieces("asked", ASKED).alias("blocks")), "sizes")
    entries = members.mapInArrow(lambda b: _entries(b, tables, 1, "ids", only), "table int, width int, bucket int, ids array<long>, vector array<double>")
    probed = queries.mapInArrow(lambda b: _entries(b, tables, probes, "query_id", only), "table int, width int, bucket int, query_id long, vector array<double>")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    held = entries.join(sizes, ["table", "width", "bucket"]).withColumn("part", F.pmod(F.xxhash64("ids"), F.col("parts"))).withColumn("block", each("blocks"))
    asked = probed.join(sizes, ["table", "width", "bucket"]).withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks"))).withColumn("part", each("parts"))
    return asked.select(*KEYS, "query_id", "vector"), held.select(*KEYS, "ids", "vector")


def _found(members: DataFrame, queries: DataFrame, tables: int, probes: int, k: int, only: int | None = None) -> DataFrame:
    """Per query and part of a probed bucket the k nearest: query_id, vec_id, score."""
    asked, held = _dealt(members, queries, tables, probes, only)

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return _rank(left, right, k)

    return asked.groupBy(*KEYS).cogroup(held.groupBy(*KEYS)).applyInArrow(near, "query_id long, vec_id long, score double")


def search(rows: DataFrame, queries: DataFrame, k: int = K, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """The k nearest found for each query: query_id, rank, vec_id, score (Euclidean distance in double precision).

    rows and queries: vec_id and vector.  Vectors that are null, all zero or hold null or non-finite components take no
    part, and only vectors of equal width meet.  A row is never its own neighbour; repeated rows count once; ties go to
    the smaller id.  Queries that met fewer than k others in their buckets look into every bucket of the first table,
    which holds all vectors, so an answer is short only if there are no more candidates."""
    double = lambda df: df.where(valid(F.col("vector"))).select("vec_id", F.transform("vector", lambda x: x.cast("double")).alias("vector"))
    members = stored(index(double(rows), k), "vectors")
    asked = stored(double(queries).select(F.col("vec_id").alias("query_id"), "vector").distinct(), "queries")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = lambda df: df.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    first = stored(best(_found(members, asked, tables, probes, k)), "near")
    short = asked.join(first.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left").where(F.coalesce("n", F.lit(0)) < k).select("query_id", "vector")
    wide = 1 << 30
    rest = best(_found(members, short, tables, wide, k, only=0))
    kept = first.join(short.select("query_id").distinct(), "query_id", "left_anti")
    return kept.unionByName(rest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(embeddings: DataFrame) -> DataFrame:
    """search() for the stated query set: rows whose vec_id is divisible by 100, against all rows."""
    rows = embeddings.where(F.col("vec_id").isNotNull()).select("vec_id", F.col("embedding").alias("vector"))
    return search(rows, rows.where(F.col("vec_id") % 100 == 0))
