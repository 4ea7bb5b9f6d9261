"""Removal of passages that stand in an earlier document, by sorted suffix tuples.

A string of LENGTH bytes counts as repeated if it also starts in a document with a smaller id.  As in induced sorting
only sampled suffixes are sorted and the order of all others is induced from them.  The sample has one suffix for every
string of LENGTH bytes: of the suffixes that begin in it with DEPTH bytes inside it, the one whose DEPTH bytes have the
least fingerprint (the part that least-type suffixes play in the textbook, but with a bounded reach).  The tuple of a
sampled suffix holds the name of its first DEPTH bytes, the name of the longest stretch whose strings all depend on it,
and the document.  Tuples are dealt by name to sorted shards:

* equal stretches have all their strings in common, so the whole stretch is decided by the smallest document;
* equal first bytes with different stretches have a common prefix that ends inside; only there induction goes one level
  down, and the strings of these stretches are themselves sorted and compared.

Names are 64-bit fingerprints.  Shards, and the documents that are cut in the end, are as many as the bytes need; a
task holds one shard.  Within a batch only the smallest document of a stretch is sent on, so a passage that a third of
all documents share is a row per batch and not per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matricula.session import stored

LENGTH = 50
DEPTH = 28
SHARD_BYTES = 8 << 20  # input bytes per shard
PIECE = 1 << 20  # bytes that are worked on at once; longer texts are cut with LENGTH - 1 bytes of overlap
ROWS = 2500  # rows of a batch that are worked on at once
SEND_IDS = 2_000_000  # ids up to which a list of them is sent to every task
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
LOW = U((1 << 24) - 1)
SHORT = U((1 << 48) - 1)  # a stretch is told apart from others with the same first bytes by 48 bits

_rng = np.random.default_rng(10)
LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the powers 0..n and the inverses, modulo 2 to the 64."""
    if n >= len(_powers.up):
        size = max(n + 1, PIECE + LENGTH + 2)
        inverse = U(pow(int(BASE), -1, 1 << 64))
        _powers.up = np.cumprod(np.r_[U(1), np.full(size, BASE, U)], dtype=U)
        _powers.down = np.cumprod(np.r_[U(1), np.full(size, inverse, U)], dtype=U)
    return _powers.up, _powers.down


_powers.up = _powers.down = np.zeros(0, U)


class Prints:
    """Fingerprints of any stretch of a byte string, from running sums."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(LETTER[data] * up[:len(data)], dtype=U, out=self.sums[1:])

    def every(self, size: int) -> np.ndarray:
        """Of the stretch of that size at every place."""
        n = max(0, len(self.sums) - size)
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n else np.zeros(0, U)

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin])


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The texts laid end to end in pieces: bytes, and for each part its place in the piece, text number and place in
    that text.  Texts too short for one string are left out; parts of a long text overlap by LENGTH - 1 bytes."""
    lines: list[bytes] = []
    where: list[tuple[int, int, int]] = []
    size = 0

    def done():
        at = np.array(where, np.int64).reshape(-1, 3)
        return np.frombuffer(b"".join(lines), np.uint8), at[:, 0], at[:, 1], at[:, 2]

    for number, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for begin in range(0, len(text) - LENGTH + 1, PIECE - LENGTH + 1):
            part = text[begin:begin + PIECE]
            if lines and size + len(part) > PIECE:
                yield done()
                lines, where, size = [], [], 0
            lines.append(part)
            where.append((size, number, begin))
            size += len(part)
    if lines:
        yield done()


def samples(data: np.ndarray, begins: np.ndarray):
    """The sampled suffixes of a piece: place of the first and the last string that depend on each, the name of its
    first bytes, the name of the stretch, and the piece's Prints."""
    prints = Prints(data)
    heads = prints.every(DEPTH)
    least = (heads & ~LOW) | np.arange(len(heads), dtype=U)
    width, reach = LENGTH - DEPTH + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(least) - (width - reach)], least[width - reach:])
    chosen = (least & LOW).astype(np.int64)  # for the string at each place
    part = np.searchsorted(begins, np.arange(len(chosen)), "right") - 1
    ends = np.r_[begins[1:], len(data)]
    valid = np.arange(len(chosen)) + LENGTH <= ends[part]
    new = np.r_[True, (chosen[1:] != chosen[:-1]) | (part[1:] != part[:-1])]
    first = np.flatnonzero(new & valid)
    stop = np.flatnonzero(valid & np.r_[new[1:] | ~valid[1:], True])
    head = heads[chosen[first]]
    stretch = mixed(prints.of(first, stop + LENGTH) + mixed(((chosen[first] - first) * LENGTH + (stop - first)).astype(U))) & SHORT
    return first, stop, head, stretch, part[first], prints


def _tag(head: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """One name for both, its last bit free for a mark."""
    return mixed(head + U(0x1234567) * stretch) & ~U(1)


def _bytes(column) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t is not None else b"" for t in column.to_pylist()]


def _shard_of(doc: np.ndarray, shards: int) -> np.ndarray:
    """The shard of documents; the same as the column in _dealt."""
    return (doc ^ (doc >> 20)) % shards


def _dealt(docs: DataFrame, shards: int) -> DataFrame:
    return docs.withColumn("shard", F.expr(f"cast(pmod(doc_id ^ shiftright(doc_id, 20), {shards}) as int)"))


def packed(values: np.ndarray) -> bytes:
    """Names as they are; whole numbers as a first value and 32-bit steps from the least one where these suffice."""
    if values.dtype == U:
        return values.tobytes()
    least = values.min() if len(values) else np.int64(0)
    wide = len(values) > 0 and int(values.max()) - int(least) >= 1 << 32
    return np.array([wide, least], np.int64).tobytes() + (values if wide else (values - least).astype(np.uint32)).tobytes()


def packed_short(values: np.ndarray) -> bytes:
    """Names of 48 bits."""
    return values.astype(np.uint32).tobytes() + (values >> U(32)).astype(np.uint16).tobytes()


def unpacked(blob: pa.Scalar, kind: str) -> np.ndarray:
    data = blob.as_buffer()
    if kind == "name":
        return np.frombuffer(data, U)
    if kind == "short":
        n = data.size // 6
        return np.frombuffer(data, np.uint32, n).astype(U) | (np.frombuffer(data, np.uint16, n, 4 * n).astype(U) << U(32))
    wide, least = np.frombuffer(data, np.int64, 2)
    return np.frombuffer(data, np.int64, -1, 16) if wide else np.frombuffer(data, np.uint32, -1, 16).astype(np.int64) + least


def _blobs(shard: np.ndarray, columns: list[np.ndarray], shards: int, kind: int, short: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows (shard, kind, blobs of columns), one per shard that occurs; the column `short` has 48 bits."""
    if not len(shard):
        return
    order = np.argsort(shard, kind="stable")
    used, begin = np.unique(shard[order], return_index=True)
    cuts = list(zip(begin, np.r_[begin[1:], len(order)], strict=True))
    blobs = []
    for k in range(3):
        column = columns[k][order] if k < len(columns) else None
        blobs.append(pa.array([None if column is None else (packed_short if k == short else packed)(column[a:b]) for a, b in cuts], pa.binary()))
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(np.full(len(used), kind, np.int32)), *blobs], names=["shard", "kind", "x", "y", "z"])


BLOB = "shard int, kind int, x binary, y binary, z binary"


def _scan(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Suffix tuples dealt by the name of their first bytes: kind 0 rows hold names, stretches and documents; kind 1
    rows, dealt evenly, hold documents and tags of stretches that a smaller document of the batch has."""
    for batch in (whole.slice(begin, ROWS) for whole in batches for begin in range(0, whole.num_rows, ROWS)):
        texts, ids = _bytes(batch["text"]), batch["doc_id"].to_numpy().astype(np.int64)
        heads, stretches, docs = [], [], []
        for data, begins, number, _ in pieces(texts):
            _, _, head, stretch, part, _ = samples(data, begins)
            heads.append(head)
            stretches.append(stretch)
            docs.append(ids[number[part]])
        if not heads:
            continue
        head, stretch, doc = np.concatenate(heads), np.concatenate(stretches), np.concatenate(docs)
        order = np.lexsort((doc, stretch, head))
        head, stretch, doc = head[order], stretch[order], doc[order]
        new = np.r_[True, (head[1:] != head[:-1]) | (stretch[1:] != stretch[:-1])]
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        again = ~new & (doc > least)
        known = np.flatnonzero(again)
        yield from _blobs(_shard_of(doc[known], shards), [doc[known], _tag(head[known], stretch[known])], shards, 1)
        yield from _blobs((head[new] % U(shards)).astype(np.int64), [head[new], stretch[new], doc[new]], shards, 0, short=1)


def _joined(table: pa.Table, kind: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    """The columns of all rows of a kind, laid end to end."""
    rows = [i for i, k in enumerate(table["kind"].to_pylist()) if k == kind]
    return [np.concatenate([np.zeros(0, np.int64 if k == "int" else U), *[unpacked(table[name][i], k) for i in rows]]) for name, k in zip("xyz", kinds, strict=False)]


def _no_rows() -> pa.Table:
    return pa.table({"shard": pa.array([], pa.int32()), "kind": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in "xyz"}})


def _match(table: pa.Table, shards: int) -> pa.Table:
    """Sorts a shard's tuples and decides stretches; rows dealt by document: documents and tags, the mark set where the
    strings have to be compared one by one."""
    head, stretch, doc = _joined(table, 0, ("name", "short", "int"))
    known_doc, known_tag = _joined(table, 1, ("int", "name"))
    order = np.lexsort((doc, stretch, head))
    head, stretch, doc = head[order], stretch[order], doc[order]
    out_doc, out_tag = [known_doc], [known_tag]
    if len(head):
        new_head = np.r_[True, head[1:] != head[:-1]]
        new = np.r_[True, new_head[1:] | (stretch[1:] != stretch[:-1])]
        least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
        whole = doc > least
        out_doc.append(doc[whole])
        out_tag.append(_tag(head[whole], stretch[whole]))
        # First bytes with several stretches, of more than one document: each stretch's smallest document shows its strings.
        group = np.cumsum(new_head) - 1
        begin = np.flatnonzero(new_head)
        several = np.add.reduceat(new.astype(np.int64), begin) > 1
        several &= np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin)
        open_ = new & several[group]
        out_doc.append(doc[open_])
        out_tag.append(_tag(head[open_], stretch[open_]) | U(1))
    doc, tag = np.concatenate(out_doc), np.concatenate(out_tag)
    batches = list(_blobs(_shard_of(doc, shards), [doc, tag], shards, 0))
    return pa.Table.from_batches(batches) if batches else _no_rows()


def _expand(docs: pa.Table, flags: pa.Table, shards: int) -> pa.Table:
    """For a shard of documents: kind 0 rows with document, first and last string of decided stretches, dealt by
    document; kind 1 rows with names of single strings, documents and places, dealt by name."""
    doc, tag = _joined(flags, 0, ("int", "name")) if flags.num_rows else (np.zeros(0, np.int64), np.zeros(0, U))
    if not docs.num_rows or not len(doc):
        return _no_rows()
    key = np.sort(mixed(doc.astype(U)) + tag)
    texts, ids = _bytes(docs["text"]), docs["doc_id"].to_numpy().astype(np.int64)
    whole: list[list[np.ndarray]] = [[], [], []]
    single: list[list[np.ndarray]] = [[], [], []]
    for data, begins, number, offset in pieces(texts):
        first, stop, head, stretch, part, prints = samples(data, begins)
        own = mixed(ids[number[part]].astype(U)) + _tag(head, stretch)
        found = lambda k: key[np.minimum(np.searchsorted(key, k), len(key) - 1)] == k  # noqa: E731, B023
        move = (offset - begins)[part]
        all_of, some = found(own), found(own + U(1))
        for to, values in zip(whole, (ids[number[part]], first + move, stop + move), strict=True):
            to.append(values[all_of])
        some &= ~all_of
        if some.any():
            size = (stop - first + 1)[some]
            at = np.repeat(first[some], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            for to, values in zip(single, (prints.of(at, at + LENGTH), np.repeat(ids[number[part]][some], size), at + np.repeat(move[some], size)), strict=True):
                to.append(values)
        # Strings of a stretch that is decided may still be the first ones that another document's stretch needs, but
        # then the smaller document that decided it shows them.
    batches: list[pa.RecordBatch] = []
    if whole[0]:
        d, a, b = (np.concatenate(x) for x in whole)
        batches += _blobs(_shard_of(d, shards), [d, a.astype(np.int64), b.astype(np.int64)], shards, 0)
    if single[0]:
        name, d, at = (np.concatenate(x) for x in single)
        batches += _blobs((name % U(shards)).astype(np.int64), [name, d.astype(np.int64), at.astype(np.int64)], shards, 1)
    return pa.Table.from_batches(batches) if batches else _no_rows()


def _compare(table: pa.Table, shards: int) -> pa.Table:
    """Single strings of a shard that a smaller document has: document, first and last string, dealt by document."""
    name, doc, at = _joined(table, 1, ("name", "int", "int"))
    order = np.lexsort((doc, name))
    name, doc, at = name[order], doc[order], at[order]
    if not len(name):
        return _no_rows()
    new = np.r_[True, name[1:] != name[:-1]]
    gone = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    doc, at = doc[gone], at[gone]
    batches = list(_blobs(_shard_of(doc, shards), [doc, at, at], shards, 0))
    return pa.Table.from_batches(batches) if batches else _no_rows()


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cut(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """The maximal runs covered by strings that start at first..last, and what is left of the text."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
    new = np.r_[True, first[1:] > end[:-1]] if len(first) else np.zeros(0, bool)
    begin = first[new]
    stop = end[np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]] if len(first) else end
    runs = list(zip(begin.tolist(), stop.tolist(), strict=True))
    kept, at = [], 0
    for a, b in runs:
        kept.append(text[at:a])
        at = b
    return runs, b"".join([*kept, text[at:]])


def _finish(docs: pa.Table, cuts: pa.Table, texts_out: bool) -> pa.Table:
    doc, first, last = _joined(cuts, 0, ("int",) * 3) if cuts.num_rows else (np.zeros(0, np.int64),) * 3
    order = np.argsort(doc, kind="stable")
    doc, first, last = doc[order], first[order], last[order]
    rows = []
    for doc_id, text in zip(docs["doc_id"].to_pylist(), _bytes(docs["text"]), strict=True):
        a, b = np.searchsorted(doc, [doc_id, doc_id + 1])
        # Places beyond this text belong to another text of the same id.
        fits = last[a:b] + LENGTH <= len(text)
        runs, kept = cut(text, first[a:b][fits], last[a:b][fits])
        rows.append((doc_id, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if texts_out else None))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"), kinds, strict=True))})


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = [unpacked(x, "int") for x in batch["x"]]
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(docs)) if docs else np.zeros(0, np.int64))], names=["doc_id"])


def _known_ids(blobs: DataFrame, label: str) -> DataFrame:
    """The documents that blobs name in x."""
    return stored(blobs.select("x").mapInArrow(_ids, "doc_id long").distinct(), label)


def _listed(ids: DataFrame) -> DataFrame:
    """ids, marked for sending to every task if there are at most SEND_IDS."""
    return F.broadcast(ids) if ids.limit(SEND_IDS + 1).count() <= SEND_IDS else ids


def remove_repeats(docs: DataFrame, texts_out: bool = False) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept.

    Null texts are empty.  A row without an id has no place in the order: nothing is removed from it or because of it.
    Rows with one id are one document: they do not remove each other's text.  A text that a smaller id has as a whole
    goes as a whole; only the smallest of equal texts is searched.  Texts move between tasks only if something of them
    is repeated."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    coded = rows.withColumn("code", F.sha2("text", 256))
    sized = stored(coded.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "code"), "sized")
    total = sized.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES)) | 1
    least = sized.where(F.col("doc_id").isNotNull() & (F.col("n_bytes") >= LENGTH)).groupBy("code").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    copies = stored(sized.join(least.where("least < most"), "code").where("doc_id > least").select("doc_id", "code").distinct(), "copies")
    searched = coded.join(_listed(copies), ["doc_id", "code"], "left_anti").where(F.col("doc_id").isNotNull()).select("doc_id", "text")

    tuples = searched.mapInArrow(lambda b: _scan(b, shards), BLOB)
    flags = stored(tuples.groupBy("shard").applyInArrow(lambda t: _match(t, shards), BLOB), "flags")
    asked = _dealt(searched.join(_listed(_known_ids(flags, "flagged")), "doc_id", "left_semi"), shards)
    expanded = stored(asked.groupBy("shard").cogroup(flags.groupBy("shard")).applyInArrow(lambda d, f: _expand(d, f, shards), BLOB), "stretches")
    compared = expanded.where("kind = 1").groupBy("shard").applyInArrow(lambda t: _compare(t, shards), BLOB)
    cuts = stored(expanded.where("kind = 0").unionByName(compared), "cuts")
    cut_ids = _known_ids(cuts, "cut")
    changed = _dealt(searched.join(_listed(cut_ids), "doc_id", "left_semi"), shards)
    changed = changed.groupBy("shard").cogroup(cuts.groupBy("shard")).applyInArrow(lambda d, c: _finish(d, c, texts_out), OUT)

    rest = coded.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "code", F.encode("text", "utf-8").alias("kept")) if texts_out else sized.withColumn("kept", F.lit(None).cast("binary"))
    rest = rest.join(copies.withColumn("copy", F.lit(True)), ["doc_id", "code"], "left").join(cut_ids.withColumn("cut", F.lit(True)), "doc_id", "left")
    rest = rest.where("copy or cut is null")
    gone = F.col("copy").isNotNull()
    rest = rest.select(
        "doc_id", "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(0).alias("n_removed"), F.when(gone, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("code")).alias("kept_sha256"), F.when(gone & F.lit(texts_out), F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    out = rest.unionByName(changed)
    return out if texts_out else out.drop("kept")
