"""Toxicity by multiple-instance learning: sentences score, a noisy-or joins them, only documents carry labels.

A sentence's chance is the logistic of a bias and the weights of its different words; a text is toxic unless all of its
sentences are not.  The model learns from a bounded sample of labelled documents and then names offending sentences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matricula.session import stored

TRAIN_DOCS = 6000  # labelled documents of each label, on average at most
MAX_WORDS = 4000  # words with a weight
LEAST_SENTENCES = 5  # different sentences of the sample in which such a word stands
STRENGTH = 4.0  # standard errors by which its share must differ between the labels
TOXIC = 0.7
SENTENCES = re.compile(r"[^.!?\n]+")
TOKENS = re.compile(r"\w+")

STEM = 6  # letters of a word's beginning that count as a word of their own, with "*" after them


def features(sentence: str) -> set[str]:
    """The different words of a lower-cased sentence and the beginnings of the long ones."""
    found = set(TOKENS.findall(sentence))
    return found | {w[:STEM] + "*" for w in found if len(w) > STEM}


def held_out(doc_id: Column) -> Column:
    """Rows that take no part in learning: crc32 of the id as text leaves 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    words: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -6.0
    slope: float = 1.0  # of the calibration: the noisy-or's log-odds times slope plus shift
    shift: float = 0.0


def sample(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> DataFrame:
    """Different texts with their label and weight (text, toxic, weight): of each label as many as per_label on average,
    with the number of documents that one drawn stands for as weight.

    Ids are drawn before any text is read; a document with several labels counts as toxic if one says so."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(1.0)
    for label, n in sizes.items():
        rate = F.when(F.col("toxic") == label, F.lit(min(1.0, per_label / n))).otherwise(rate)
    drawn = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rate * (1 << 30)).withColumn("weight", 1.0 / rate)
    # The draw is bounded by per_label, so it may go to every task.
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(drawn), "doc_id")
    return stored(texts.groupBy("text").agg(F.max("toxic").alias("toxic"), F.max("weight").alias("weight")), "toxicity-sample")


def _sentence_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sentence, word, toxic = [], [], []
        for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            for part in SENTENCES.findall(text.lower()):
                for w in features(part):
                    sentence.append(part)
                    word.append(w)
                    toxic.append(label)
        # A sentence's hash stands for it; copies of a sentence count once.
        yield pa.RecordBatch.from_arrays([pa.array([hash_of(s) for s in sentence], pa.int64()), pa.array(word, pa.string()), pa.array(toxic, pa.int32())], names=["sentence", "word", "toxic"])


def hash_of(text: str) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).astype(np.int64))


def choose_words(drawn: DataFrame) -> list[str]:
    """Words whose share of different sentences differs between the labels by STRENGTH standard errors."""
    each = drawn.mapInArrow(_sentence_words, "sentence long, word string, toxic int").groupBy("sentence", "word").agg(F.max("toxic").alias("toxic"))
    counts = each.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    totals = each.select("sentence", "toxic").groupBy("sentence").agg(F.max("toxic").alias("toxic")).agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    bad, good = float(totals["bad"] or 0), float((totals["n"] or 0) - (totals["bad"] or 0))
    if not bad or not good:
        return []
    a, b = F.col("bad") / bad, (F.col("n") - F.col("bad")) / good
    pooled = F.col("n") / (bad + good)
    z = F.abs(a - b) / F.sqrt(pooled * (1 - pooled) * F.lit(1 / bad + 1 / good) + F.lit(1e-12))
    kept = counts.where((F.col("n") >= LEAST_SENTENCES) & (z >= STRENGTH)).orderBy(F.desc(z), "word").limit(MAX_WORDS).select("word").collect()
    return sorted(r["word"] for r in kept)


def sentence_bags(texts: list[str], numbers: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sentences with known words: their text's number, words laid end to end, words per sentence; and sentences per text."""
    owner, flat, sizes, many = [], [], [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        parts = SENTENCES.findall(text.lower())
        many[k] = len(parts)
        for part in parts:
            hit = {numbers[w] for w in features(part) if w in numbers}
            if hit:
                owner.append(k)
                flat.extend(hit)
                sizes.append(len(hit))
    return np.array(owner, np.int64), np.array(flat, np.int64), np.array(sizes, np.int64), many


def _gather(batches: Iterator[pa.RecordBatch], numbers: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch["text"].to_pylist()
        owner, flat, sizes, many = sentence_bags(texts, numbers)
        cuts = np.cumsum(sizes)
        per: list[list[list[int]]] = [[] for _ in texts]
        for k, size, end in zip(owner, sizes, cuts, strict=True):
            per[k].append(flat[end - size:end].tolist())
        yield pa.RecordBatch.from_arrays([batch["toxic"].cast(pa.int32()), batch["weight"], pa.array(many, pa.int64()), pa.array(per, pa.list_(pa.list_(pa.int64())))], names=["toxic", "weight", "sentences", "bags"])


def fit(rows: list, words: list[str], rounds: int = 1000, rate: float = 0.5, ridge: float = 1e-4) -> Model:
    """Weights by gradient steps on the noisy-or likelihood; rows: (toxic, weight, sentences, bags of word numbers).

    Sentences without a known word share the chance that the bias gives.  Where many sentences offend none of them need
    be certain, so in the end the noisy-or is calibrated against the labels once more."""
    y = np.array([float(r["toxic"]) for r in rows])
    heavy = np.array([float(r["weight"]) for r in rows])
    heavy = heavy / heavy.mean() if len(heavy) else heavy
    owner = np.array([k for k, r in enumerate(rows) for _ in r["bags"]], np.int64)
    sizes = np.array([len(b) for r in rows for b in r["bags"]], np.int64)
    flat = np.array([w for r in rows for b in r["bags"] for w in b], np.int64)
    plain = np.array([r["sentences"] - len(r["bags"]) for r in rows], float)
    if not len(y) or y.min() == y.max():
        return Model()
    weights, bias = np.zeros(len(words)), -5.0
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    past_w, past_b = np.full(len(words), 1e-8), 1e-8
    for _ in range(rounds):
        z = bias + np.bincount(sentence, weights[flat], len(sizes)) if len(sizes) else np.zeros(0)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + np.exp(-np.clip(bias, -30, 30)))
        quiet = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)) + plain * np.log1p(-p0)
        chance = np.clip(1 - np.exp(quiet), 1e-9, 1 - 1e-12)
        # d log-likelihood / d z of a sentence: p where the text is toxic scaled by its doubt, -p where it is not.
        pull = heavy * np.where(y > 0, (1 - chance) / chance, -1.0)
        grad_z = pull[owner] * p
        grad_w = np.bincount(flat, grad_z[sentence], len(words)) / len(y) - ridge * weights if len(words) else weights
        grad_b = (grad_z.sum() + (pull * plain).sum() * p0) / len(y)
        past_w, past_b = past_w + grad_w ** 2, past_b + grad_b ** 2
        # No word speaks for innocence: harmless words around an offending one do not excuse it.
        weights = np.maximum(0.0, weights + rate * grad_w / np.sqrt(past_w))
        bias = min(-3.0, bias + rate * grad_b / np.sqrt(past_b))
    odds = np.log(chance / (1 - chance))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(slope * odds + shift, -30, 30)))
        gap, curve = heavy * (y - q), heavy * q * (1 - q) + 1e-9
        grad = np.array([(gap * odds).sum() - 0.01 * (slope - 1), gap.sum()])
        hess = np.array([[(curve * odds ** 2).sum() + 0.01, (curve * odds).sum()], [(curve * odds).sum(), curve.sum()]])
        step = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        slope, shift = max(0.1, slope + step[0]), shift + step[1]
    return Model(words, weights, float(bias), float(slope), float(shift))


def learn(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS) -> Model:
    """The model of labelled documents; without both labels one that finds nothing."""
    drawn = sample(docs, labels, per_label)
    words = choose_words(drawn)
    numbers = {w: k for k, w in enumerate(words)}
    rows = drawn.mapInArrow(lambda b: _gather(b, numbers), "toxic int, weight double, sentences long, bags array<array<long>>").collect()
    return fit(rows, words)


def score_texts(texts: list[str | None], model: Model) -> tuple[np.ndarray, list[np.ndarray]]:
    """Chance of each text and of its sentences in order; a text without sentences has chance 0."""
    numbers = {w: k for k, w in enumerate(model.words)}
    owner, flat, sizes, many = sentence_bags([t or "" for t in texts], numbers)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    z = model.bias + (np.bincount(sentence, model.weights[flat], len(sizes)) if len(sizes) else np.zeros(0))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    p0 = 1 / (1 + np.exp(-model.bias))
    known = np.bincount(owner, minlength=len(texts)) if len(texts) else np.zeros(0)
    quiet = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(texts)) + (many - known) * np.log1p(-p0) if len(texts) else np.zeros(0)
    chance = np.clip(1 - np.exp(quiet), 1e-12, 1 - 1e-12)
    score = 1 / (1 + np.exp(-np.clip(model.slope * np.log(chance / (1 - chance)) + model.shift, -30, 30)))
    return np.where(many > 0, score, 0.0), p


def offending(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The sentences that speak for toxicity: doc_id, start, end (code points of the text), sentence, chance."""
    handed = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = handed.value
        numbers = {w: k for k, w in enumerate(known.words)}
        for batch in batches:
            rows = []
            for row, text in enumerate(batch["text"].to_pylist()):
                for m in SENTENCES.finditer(text or ""):
                    hit = {numbers[w] for w in features(m.group().lower()) if w in numbers}
                    p = 1 / (1 + np.exp(-np.clip(known.bias + known.weights[sorted(hit)].sum(), -30, 30))) if hit else 0.0
                    if p >= least:
                        rows.append((row, m.start(), m.end(), m.group(), float(p)))
            ids = batch["doc_id"].take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array([r[i] for r in rows], t) for i, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.string()), (4, pa.float64()))]], names=["doc_id", "start", "end", "sentence", "chance"])

    return docs.select("doc_id", "text").mapInArrow(locate, f"doc_id {kind}, start long, end long, sentence string, chance double")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of documents: doc_id, held_out, score, predicted.

    Null and empty texts score 0.  Only ids, labels and texts of rows that are not held out are learned from; nothing
    but the text goes into a score.  Repeated rows get equal rows."""
    handed = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chances, _ = score_texts(batch["text"].to_pylist(), handed.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(chances, pa.float64()), pa.array((chances >= TOXIC).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
