"""Language identification by unigrams over a public vocabulary, summed over all segmentations.

A word's chance in a language is the sum, over every way to cut it into pieces of the vocabulary, of the product of the
language's piece probabilities; the forward algorithm gives it without listing the cuts.  Words do not share pieces, so
a text's log-chance is a sum over its words and each different word of a batch is worked out once, all words of a
batch side by side.  Probabilities are fitted by expectation and maximisation on word counts of a bounded sample.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
TRAIN_DOCS = 2000  # labelled documents per language, on average at most
TRAIN_WORDS = 50_000  # a language's most frequent different words in these
SPREADS, LEAST = 3.0, 2.5  # a text may lie so many spreads of its language's words below their mean, and so much at least
SLACK = 12.0  # and the log-chance that a text may lack besides, so that few letters prove nothing
SPAN = 1 << 17  # more than there are letters in a vocabulary
AT_ONCE = 10_000  # words that are worked on side by side
WORDS_AT_ONCE = 2000  # and with all languages at once: some kilobytes a word
PART = 2500  # texts that are worked on at once
ARROW_ROWS = 2000  # rows in one batch between Spark and Python: a text is some kilobytes
LONGEST = 32  # letters; longer words are cut into parts of this length
MIN_CHANCE = 0.5
UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")


def pieces(path: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces that are letters alone, lower-cased; "^" marks a word's beginning."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = {model.id_to_piece(i).replace("▁", "^").lower() for i in range(model.get_piece_size())}
    return sorted(t for t in texts if t.lstrip("^").isalpha() and t.count("^") <= 1 and len(t) <= LONGEST)


@dataclass
class Trie:
    """Pieces as steps from node to node, kept in an open hash table: keys holds node * SPAN + letter (-1: free slot),
    to the next node; piece[node] is the piece's number or -1."""

    letters: dict[str, int]
    keys: np.ndarray
    to: np.ndarray
    piece: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Trie:
        letters = {c: i for i, c in enumerate(sorted({c for t in texts for c in t}), 1)}
        steps: dict[int, int] = {}
        ends = [-1]
        for number, text in enumerate(texts):
            node = 0
            for c in text:
                key = node * SPAN + letters[c]
                if key not in steps:
                    steps[key] = len(ends)
                    ends.append(-1)
                node = steps[key]
            ends[node] = number
        size = 1 << (8 * max(1, len(steps)) - 1).bit_length()
        keys, to = np.full(size, -1, np.int64), np.zeros(size, np.int32)
        for key, node in steps.items():
            slot = int(Trie.slots(np.array([key]), size)[0])
            while keys[slot] >= 0:
                slot = (slot + 1) % size
            keys[slot], to[slot] = key, node
        return Trie(letters, keys, to, np.array(ends, np.int32))

    @staticmethod
    def slots(key: np.ndarray, size: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next nodes; 0 where there is none."""
        key = node.astype(np.int64) * SPAN + letter
        slot = Trie.slots(key, len(self.keys))
        seen = self.keys[slot]
        out = np.where(seen == key, self.to[slot], 0)
        left = np.flatnonzero((seen != key) & (seen >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) % len(self.keys)
            seen = self.keys[slot[left]]
            hit = seen == key[left]
            out[left[hit]] = self.to[slot[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out

    def lookup(self) -> np.ndarray:
        table = np.zeros(0x110000, np.int32)
        for c, k in self.letters.items():
            table[ord(c)] = k
        return table


def encode(words: list[str], lookup: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter numbers of all words, each with "^" before it, laid end to end; and the words' lengths."""
    line = "".join("^" + w for w in words)
    codes = lookup[np.frombuffer(line.encode("utf-32-le"), np.uint32)]
    return codes, np.fromiter((len(w) + 1 for w in words), np.int64, len(words))


def matches(codes: np.ndarray, lengths: np.ndarray, trie: Trie) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces in all words: place of the first letter, number of letters, piece."""
    begin = np.arange(len(codes))
    stop = np.repeat(np.cumsum(lengths), lengths)
    node, place, depth, found = np.zeros(len(codes), np.int32), begin, 0, []
    while len(place):
        node = trie.step(node, codes[place + depth])
        depth += 1
        alive = node > 0
        node, place = node[alive], place[alive]
        hit = trie.piece[node] >= 0
        if hit.any():
            found.append((place[hit], np.full(int(hit.sum()), depth, np.int64), trie.piece[node[hit]]))
        more = place + depth < stop[place]
        node, place = node[more], place[more]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def forward(lengths: np.ndarray, place: np.ndarray, size: np.ndarray, chance: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Sums over segmentations from each word's beginning: row per border (a word of n letters has n + 1), column per
    language.  single is the chance of a letter that stands alone without being a piece."""
    first = np.cumsum(lengths + 1) - (lengths + 1)
    word = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sums = np.zeros((int((lengths + 1).sum()), chance.shape[1]))
    sums[first] = 1.0
    border = first[word] + within
    order = np.argsort(within[place], kind="stable")
    at, to, p = border[place][order], (border[place] + size)[order], chance[order]
    cuts = np.searchsorted(within[place][order], np.arange(int(lengths.max(initial=0)) + 1))
    by_place = np.argsort(within, kind="stable")
    alone = np.searchsorted(within[by_place], np.arange(int(lengths.max(initial=0)) + 1))
    for k in range(len(cuts) - 1):
        here = border[by_place[alone[k]:alone[k + 1]]]
        sums[here + 1] += sums[here] * single
        a, b = cuts[k], cuts[k + 1]
        if b > a:
            # From one border the pieces end at different borders, so lengths are taken one after another.
            add, ends = sums[at[a:b]] * p[a:b], to[a:b]
            by_end = np.argsort(ends, kind="stable")
            ends = ends[by_end]
            new = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            sums[ends[new]] += np.add.reduceat(add[by_end], new, axis=0)
    return sums


def word_chances(words: list[str], trie: Trie, lookup: np.ndarray, chances: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Log-chance of every word, at most LONGEST letters each, in every language."""
    codes, lengths = encode(words, lookup)
    place, size, piece = matches(codes, lengths, trie)
    sums = forward(lengths, place, size, chances[piece], single)
    return np.log(sums[np.cumsum(lengths + 1) - 1] + 1e-300)


def parts(word: str) -> list[str]:
    return [word[i:i + LONGEST] for i in range(0, len(word), LONGEST)]


@dataclass
class Model:
    languages: list[str]
    trie: Trie
    chances: np.ndarray  # piece x language
    single: np.ndarray
    prior: np.ndarray
    least: np.ndarray | None = None  # log-chance per letter that a text of a language has at least
    letters: frozenset[str] = frozenset()  # of the labelled words


def expected(words: list[tuple[str, float]], trie: Trie, lookup: np.ndarray, chances: np.ndarray, single: np.ndarray) -> np.ndarray:
    """How often each piece is expected in these words (word, times), over all segmentations of each."""
    n = np.array([float(times) for _, times in words])
    codes, lengths = encode([w for w, _ in words], lookup)
    place, size, piece = matches(codes, lengths, trie)
    first = np.cumsum(lengths + 1) - (lengths + 1)
    word = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    # The backward sums are the forward sums of the words read from their ends.
    back_place = (np.cumsum(lengths) - lengths)[word[place]] + lengths[word[place]] - within[place] - size
    p = chances[piece][:, None]
    ahead = forward(lengths, place, size, p, single)[:, 0]
    back = forward(lengths, back_place, size, p, single)[:, 0]
    total = ahead[np.cumsum(lengths + 1) - 1]
    at = first[word[place]] + within[place]
    rest = back[first[word[place]] + lengths[word[place]] - within[place] - size]
    share = ahead[at] * p[:, 0] * rest / np.maximum(total[word[place]], 1e-300) * n[word[place]]
    return np.bincount(piece, share, len(chances))


def fit(counts: list[tuple[str, str, int]], docs: dict[str, int], texts: list[str], rounds: int = 4) -> Model:
    """Piece probabilities from word counts (language, word, n) by expectation and maximisation."""
    languages = sorted(docs)
    trie = Trie.of(texts)
    lookup = trie.lookup()
    n_pieces = len(texts)
    chances = np.full((n_pieces, len(languages)), 1.0 / max(1, n_pieces))
    single = np.full(len(languages), 1e-7)
    for k, language in enumerate(languages):
        mine = [(p, n) for lang, w, n in counts if lang == language for p in parts(w)]
        if not mine:
            continue
        for _ in range(rounds):
            seen = np.zeros(n_pieces)
            for i in range(0, len(mine), AT_ONCE):
                seen += expected(mine[i:i + AT_ONCE], trie, lookup, chances[:, k], single[k:k + 1])
            chances[:, k] = (seen + 0.05) / (seen.sum() + 0.05 * n_pieces)
    weight = np.array([float(docs[x]) for x in languages])
    return Model(languages, trie, chances, single, np.log(weight / weight.sum()) if len(languages) else weight)


def floors(counts: list[tuple[str, str, int]], model: Model) -> np.ndarray:
    """Per language the log-chance per letter below which a text is not in it: the mean over the letters of its labelled
    words less SPREADS spreads of these words, or less LEAST if that is more."""
    lookup = model.trie.lookup()
    total = np.zeros((3, len(model.languages)))  # letters, their log-chances, and these squared
    at = {name: k for k, name in enumerate(model.languages)}
    for i in range(0, len(counts), AT_ONCE):
        cut = [(at[lang], p, n) for lang, w, n in counts[i:i + AT_ONCE] for p in parts(w)]
        own = np.array([k for k, _, _ in cut])
        size = np.array([len(p) for _, p, _ in cut], float)
        weight = size * np.array([n for _, _, n in cut], float)
        each = word_chances([p for _, p, _ in cut], model.trie, lookup, model.chances, model.single)[np.arange(len(cut)), own] / size
        for row, value in enumerate((np.ones(len(cut)), each, each**2)):
            total[row] += np.bincount(own, weight * value, len(model.languages))
    letters = np.maximum(total[0], 1)
    mean = total[1] / letters
    return mean - np.maximum(LEAST, SPREADS * np.sqrt(np.maximum(total[2] / letters - mean**2, 0)))


def text_scores(texts: list[str | None], model: Model, lookup: np.ndarray) -> tuple[list[str], list[float], list[bool]]:
    """Language and posterior chance of whole texts, and whether the language fits at all; "und", 0.0 and false for null
    and for texts without a letter.

    A language does not fit if the text's log-chance in it is below model.least for each letter and SLACK in all, or if
    over half of the text's letters stand in no labelled word."""
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    flat: list[int] = []
    sizes = []
    for text in texts:
        found = WORDS.findall(text.lower()) if text else []
        sizes.append(len(found))
        flat.extend(map(numbers.__getitem__, found))
    numbers.default_factory = None  # else the dictionary holds itself and its words stay until cycles are collected
    letters = [w for w in numbers if w.isalpha() or any(c.isalpha() for c in w)]
    cut = [(numbers[w], p) for w in letters for p in parts(w)]
    table = np.zeros((len(numbers), len(model.languages)))
    has = np.zeros(len(numbers), np.int64)
    if cut and model.languages:
        owners = np.fromiter((k for k, _ in cut), np.int64, len(cut))
        np.add.at(has, owners, np.fromiter((len(p) for _, p in cut), np.int64, len(cut)))
        for i in range(0, len(cut), WORDS_AT_ONCE):
            np.add.at(table, owners[i:i + WORDS_AT_ONCE], word_chances([p for _, p in cut[i:i + WORDS_AT_ONCE]], model.trie, lookup, model.chances, model.single))
    known = dict.fromkeys(map(ord, model.letters))
    strange = np.fromiter((len(w.translate(known)) for w in numbers), np.int64, len(numbers))
    ends = np.cumsum(np.array(sizes, np.int64)) if sizes else np.zeros(0, np.int64)
    order = np.array(flat, np.int64)
    names, chances, fits = [], [], []
    for end, size in zip(ends, sizes, strict=True):
        own = order[end - size:end]
        if not size or not model.languages or not has[own].any():
            names.append(UNKNOWN)
            chances.append(0.0)
            fits.append(False)
            continue
        whole = table[own].sum(0)
        total = whole + model.prior
        best = int(np.argmax(total))
        likely = model.least is None or bool(whole[best] >= model.least[best] * has[own].sum() - SLACK)
        fits.append(likely and bool(2 * strange[own].sum() <= has[own].sum()))
        names.append(model.languages[best])
        chances.append(float(1.0 / np.exp(np.minimum(total - total[best], 0)).sum()))
    return names, chances, fits


def held_out(doc_id: Column) -> Column:
    """Rows that take no part in learning: crc32 of the id as text leaves 2 by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, per_language: int = TRAIN_DOCS) -> tuple[DataFrame, dict[str, int]]:
    """Labelled rows to learn from (lang, text), and how many rows each language has in all.

    Every language keeps rows by a hash of the text at a rate that leaves per_language different texts on average."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(rate)
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < rate * (1 << 30)
    return rows.where(part).select("lang", "text"), sizes


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            for w in WORDS.findall(text.lower()):
                counts[lang, w] = counts.get((lang, w), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])


def learn(docs: DataFrame, vocabulary: str = VOCABULARY, per_language: int = TRAIN_DOCS, most_words: int = TRAIN_WORDS) -> Model:
    """The model of documents with doc_id, text and lang; copies of a text count once.  Without labels: no languages."""
    chosen, sizes = sample(docs, per_language)
    counted = chosen.distinct().mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    common = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counted.withColumn("place", F.row_number().over(common)).where(F.col("place") <= most_words).select("lang", "word", "n")
    texts = pieces(vocabulary)
    # A language's words stay in the task that fits it, at most most_words; the driver gets what the model holds alone.
    fitted = top.groupBy("lang").applyInArrow(lambda words: _fit_language(words, texts), "lang string, chances binary, least double, letters string").toArrow()
    model = fit([], sizes, texts)  # without words: what languages without any keep
    least, letters = floors([], model), set()
    for i, lang in enumerate(fitted["lang"].to_pylist()):
        k = model.languages.index(lang)
        model.chances[:, k] = np.frombuffer(fitted["chances"][i].as_buffer(), np.float64)
        least[k] = fitted["least"][i].as_py()
        letters.update(fitted["letters"][i].as_py())
    return replace(model, least=least, letters=frozenset(letters))


def _fit_language(words: pa.Table, texts: list[str]) -> pa.Table:
    """lang, chances (of the pieces, as doubles), least and letters of one language's words (lang, word, n)."""
    words = words.sort_by([("n", "descending"), ("word", "ascending")])
    counts = list(zip(*(words[c].to_pylist() for c in ("lang", "word", "n")), strict=True))
    lang = counts[0][0]
    model = fit(counts, {lang: 1}, texts)
    return pa.table({"lang": pa.array([lang], pa.string()), "chances": pa.array([model.chances[:, 0].tobytes()], pa.binary()), "least": pa.array([floors(counts, model)[0]], pa.float64()), "letters": pa.array(["".join(sorted({c for _, w, _ in counts for c in w}))], pa.string())})


def small_batches(spark: SparkSession) -> None:
    """At most ARROW_ROWS rows in a batch between Spark and Python, from now on in this session: the rows of identify()
    and known() are made after these have returned, so the setting cannot be undone here."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most PART rows."""
    for batch in batches:
        for begin in range(0, batch.num_rows, PART):
            yield batch.slice(begin, PART)


def identify(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of documents: doc_id, held_out, lang_pred, score.  Learned from rows that are not held out.

    The text leaves the tasks no more: only ids and results come back."""
    small_batches(docs.sparkSession)
    model = learn(docs, vocabulary)
    handed = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = handed.value
        lookup = known.trie.lookup()
        for batch in sliced(batches):
            names, chances, _ = text_scores(batch["text"].to_pylist(), known, lookup)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(chances, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def known(docs: DataFrame, vocabulary: str = VOCABULARY, least: float = MIN_CHANCE) -> DataFrame:
    """docs without the rows whose language is undetermined, less likely than `least` or does not fit the text at all
    (another script, other languages far from the learned ones, random letters); their columns as they were, whatever
    their names."""
    small_batches(docs.sparkSession)
    handed = docs.sparkSession.sparkContext.broadcast(learn(docs, vocabulary))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handed.value
        lookup = model.trie.lookup()
        for batch in sliced(batches):
            names, chances, fits = text_scores(batch["text"].to_pylist(), model, lookup)
            yield batch.filter(pa.array([n != UNKNOWN and f and c >= least for n, c, f in zip(names, chances, fits, strict=True)], pa.bool_()))

    return docs.mapInArrow(judged, docs.schema)
