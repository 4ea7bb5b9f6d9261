"""Merkle manifest of a dataset with witnesses that grow as siblings complete.

Rows are leaves of a tree per source, and the sources' roots are leaves of one tree above.  Every three consecutive nodes
become their hash; the last run may hold fewer, even one.

A witness is the list of a leaf's siblings, level by level.  An Appender takes nodes in order, as a stream: a node opens
or joins the run of its level, and its witness hangs on that open subtree.  When a run's last sibling arrives, the
witnesses below it are extended by what completed, and the run's hash is appended to the level above.  Leaves are dealt
in blocks of a power of three, aligned to their source, so a block's subtree is the same as in one long stream; each
block is appended on its own, and the blocks' roots are further appends of the next round, until one node is left.  The
witnesses of a round's roots then extend those of the round below, from the top down.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matricula.session import stored

FANOUT = 3
HEIGHT = 7  # levels of a block: 2187 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(parts: list[bytes]) -> bytes:
    """sha256 of digests, each as hex text."""
    return sha256(b"".join(p.hex().encode() for p in parts)).digest()


class Appender:
    """Appends nodes to one aligned subtree of `height` levels and keeps every node's witness.

    A witness is a list of (index in the run, digests of the other nodes of the run) from the lowest level up."""

    def __init__(self, height: int):
        self.runs: list[list[tuple[bytes, list[int]]]] = [[] for _ in range(height)]  # open run: node and the leaves below it
        self.top: list[bytes] = []
        self.witnesses: list[list[tuple[int, list[bytes]]]] = []

    def append(self, node: bytes) -> None:
        self.witnesses.append([])
        self._add(0, node, [len(self.witnesses) - 1])

    def _add(self, level: int, node: bytes, leaves: list[int]) -> None:
        if level == len(self.runs):
            self.top.append(node)
            return
        self.runs[level].append((node, leaves))
        if len(self.runs[level]) == FANOUT:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        nodes = [n for n, _ in run]
        for k, (_, leaves) in enumerate(run):
            step = (k, nodes[:k] + nodes[k + 1:])
            for leaf in leaves:
                self.witnesses[leaf].append(step)
        self._add(level + 1, h(nodes), [x for _, leaves in run for x in leaves])

    def close(self) -> bytes:
        """Completes the runs that are still open, however short, and gives the root."""
        for level in range(len(self.runs)):
            if self.runs[level]:
                self._complete(level)
        return self.top[0]


def packed(witness: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([k, len(others)]) + b"".join(others) for k, others in witness)


def unpacked(data: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(data):
        k, n = data[at], data[at + 1]
        yield k, [data[at + 2 + 32 * i: at + 34 + 32 * i] for i in range(n)]
        at += 2 + 32 * n


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    for k, others in unpacked(witness):
        leaf = h([*others[:k], leaf, *others[k:]])
    return leaf


def height_of(n: int) -> int:
    """Levels of a tree over n nodes: 0 for one."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * FANOUT
    return levels


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the partition's number and each one's place in its run of equal `grp` within the partition."""
    from pyspark import TaskContext

    part, last, done = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch["grp"].fill_null("").to_pandas().to_numpy()
        nulls = batch["grp"].is_null().to_numpy(zero_copy_only=False)
        new = np.r_[True, (codes[1:] != codes[:-1]) | (nulls[1:] != nulls[:-1])]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        rank = np.arange(len(new)) - begin
        if last == (codes[0], nulls[0]):
            rank[begin == 0] += done
        last, done = (codes[-1], nulls[-1]), int(rank[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(rank), part, np.int32)), pa.array(rank)], names=[*batch.schema.names, "part", "rank"])


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes (grp, ...) with `place` in their group by `order`, and the group's `size`; written once.

    Rows are sorted by range; only the counts of each group per partition are summed up, so no group comes together."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = ["grp", *order]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + ", part int, rank long"
    ranked = stored(nodes.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).mapInArrow(_ranked, schema), "ranked")
    counts = ranked.groupBy("grp", "part").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("grp")  # a row per partition that holds the group
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("grp", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("size"))
    joined = ranked.alias("r").join(offsets.alias("o"), F.col("r.grp").eqNullSafe(F.col("o.grp")) & (F.col("r.part") == F.col("o.part")))
    return joined.select("r.*", "o.size", (F.col("r.rank") + F.col("o.before")).alias("place")).drop("part", "rank")


def _append(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Blocks, each in order of place: every node with its witness inside the block, and the block's root."""
    appender, key, height, rows = None, None, 0, []

    def done():
        root = appender.close()
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array([packed(w) for w in appender.witnesses], pa.binary()), pa.array([root if i == 0 else None for i in range(len(rows))], pa.binary())],
            names=["grp", "block", "place", "witness", "root"])

    for batch in batches:
        for grp, block, place, size, digest in zip(*(batch[c].to_pylist() for c in ("grp", "block", "place", "size", "digest")), strict=True):
            if (grp, block) != key:
                if appender is not None:
                    yield done()
                key, rows = (grp, block), []
                height = min(most, height_of(size))
                appender = Appender(height)
            appender.append(digest)
            rows.append((grp, block, place))
    if appender is not None:
        yield done()


def appended_rounds(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """nodes (grp, place, size, digest) appended block by block, then the blocks' roots, until every group has one node.

    Gives the rounds (grp, block, place, witness inside the block) and the groups' roots (grp, root)."""
    spark = nodes.sparkSession
    rounds: list[DataFrame] = []
    height = HEIGHT
    while True:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        blocks = nodes.select("grp", F.floor(F.col("place") / FANOUT**height).cast("long").alias("block"), "place", "size", "digest")
        dealt = blocks.repartition(parts, "grp", "block").sortWithinPartitions("grp", "block", "place")
        appended = stored(dealt.mapInArrow(lambda b: _append(b, height), "grp string, block long, place long, witness binary, root binary"), "appended")
        rounds.append(appended.drop("root"))
        sizes = nodes.where("place = 0").select("grp", F.ceil(F.col("size") / FANOUT**height).cast("long").alias("size"))
        tops = appended.where("root IS NOT NULL").select("grp", F.col("block").alias("place"), F.col("root").alias("digest"))
        nodes = stored(tops.alias("t").join(sizes.alias("s"), F.col("t.grp").eqNullSafe(F.col("s.grp"))).select("t.*", "s.size"), "block-roots")
        if nodes.where("place > 0").isEmpty():
            return rounds, nodes.select("grp", F.col("digest").alias("root"))


def extended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Witnesses of the lowest round (grp, place, witness, ...), extended from the top round down.

    above (grp, witness, ...) holds what each group's root gets; its other columns come along.  It meets the top round
    only, which has at most a block of rows per group."""
    extra = [c for c in above.columns if c not in ("grp", "witness")]
    top = rounds[-1].alias("t").join(above.alias("a"), F.col("t.grp").eqNullSafe(F.col("a.grp")))
    whole = top.select("t.grp", "t.place", F.concat("t.witness", "a.witness").alias("witness"), *extra)
    for below in reversed(rounds[:-1]):
        joined = below.alias("b").join(whole.alias("w"), F.col("b.grp").eqNullSafe(F.col("w.grp")) & (F.col("b.block") == F.col("w.place")))
        whole = joined.select("b.grp", "b.place", F.concat("b.witness", "w.witness").alias("witness"), *extra)
    return whole


def leaf_of(changed: dict[str, Column] | None = None) -> Column:
    """The leaf of a row: sha256 over its fields, each as its UTF-8 length and value, or `-`."""
    changed = changed or {}

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[field(c) for c in FIELDS]), 256)


def tampered_leaf() -> Column:
    """The leaf after the stated damage: where crc32 of the decimal doc_id is even, the text loses its line feeds."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, leaf_of({"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}))


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proof, fold = [], []
        for leaf, other, witness in zip(*(batch[c].to_pylist() for c in ("leaf", "other", "witness")), strict=True):
            proof.append(sha256(b"".join(o.hex().encode() for _, others in unpacked(witness) for o in others)).hexdigest())
            fold.append(folded(leaf if other is None else other, witness).hex())
        text = lambda c: pa.array([x.hex() for x in batch[c].to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], text("leaf"), text("subroot"), text("root"), pa.array(proof, pa.string()), pa.array(fold, pa.string())], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def manifest(docs: DataFrame, changed_leaf: Column | None = None) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves ascend by doc_id within a source, rows of one doc_id by their leaf, and rows without an id come first.
    changed_leaf gives a leaf to check instead of the row's own where it is not null.  No rows give no rows."""
    ids = docs.schema["doc_id"].dataType.simpleString()
    other = F.lit(None).cast("string") if changed_leaf is None else changed_leaf
    leaves = docs.select(F.col("source").alias("grp"), "doc_id", F.unhex(leaf_of()).alias("digest"), F.unhex(other).alias("other"))
    leaves = stored(placed(leaves, ["doc_id", "digest", "other"]), "leaves")
    rounds, subroots = appended_rounds(leaves.select("grp", "place", "size", "digest"))
    sources = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("digest"))
    sources = stored(placed(sources, ["name"]), "sources")
    upper, root = appended_rounds(sources.select("grp", "place", "size", "digest"))
    nothing = F.lit(b"")
    outer = extended(upper, root.select("grp", nothing.alias("witness"), "root"))
    tops = sources.join(outer.select("place", "witness", "root"), "place").select(F.col("name").alias("grp"), "witness", F.col("digest").alias("subroot"), "root")
    inner = extended(rounds, stored(tops, "tops"))
    own = leaves.alias("l").join(inner.alias("w"), F.col("l.grp").eqNullSafe(F.col("w.grp")) & (F.col("l.place") == F.col("w.place")))
    rows = own.select("l.doc_id", F.col("l.digest").alias("leaf"), "l.other", "w.subroot", "w.root", "w.witness")
    out = rows.mapInArrow(_judged, f"doc_id {ids}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
