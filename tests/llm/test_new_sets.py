"""Manifest, SimHash near-duplicates and ranked search against plain versions and, for odd tables, their SQL."""

import random
import zlib
from hashlib import sha256
from math import log

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from matricula.llm import manifest, ranking, simhash, sql
from messy import EN, LONG, cases, documents, rows_of
from test_sets import SORT, smallest

# --- manifest ---


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Root and, per node, the lists of its siblings by level."""
    paths, below, level = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
    while len(level) > 1:
        nxt, held = [], []
        for b in range(0, len(level), 3):
            run = level[b:b + 3]
            for k in range(len(run)):
                for leaf in below[b + k]:
                    paths[leaf].append((k, run[:k] + run[k + 1:]))
            nxt.append(H(*run))
            held.append([x for m in below[b:b + 3] for x in m])
        level, below = nxt, held
    return level[0], paths


def plain_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""

    def leaf(r, text):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))

    def other(r):
        return leaf(r, r[4].replace("\n", "") if r[4] is not None else None) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else None

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], leaf(r, r[4]), other(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        trees[s] = plain_tree([t[1] for t in groups[s]])
    root, above = plain_tree([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for (i, own, changed), path in zip(groups[s], trees[s][1]):
            node = changed or own
            for k, others in path + up:
                node = H(*others[:k], node, *others[k:])
            out.append((i, own, trees[s][0], root, H(*(o for _, others in path + up for o in others)), node, node == root))
    return sorted(out, key=SORT)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest(spark, monkeypatch, height):
    """Blocks of 3, 9 and 2187 leaves: rounds of appends give the tree that one list gives."""
    monkeypatch.setattr(manifest, "HEIGHT", height)
    rng = random.Random(height)
    rows = [(*r, *[None] * (4 - len(r)))[:4] for r in cases()]
    rows += [(100 + i, rng.choice(("a\nb", "é\n\n日本", "plain", None)), "en", rng.choice(("src1", "src1", "src1", "ß", "", None, f"s{i % 30}"))) for i in range(300)]
    docs = documents(spark, rows)
    want = plain_manifest([tuple(r[c] for c in FIELDS) for r in docs.collect()])
    got = manifest.manifest(docs.repartition(5), manifest.tampered_leaf())
    assert rows_of(got) == want
    assert rows_of(manifest.manifest(docs).select("verified").distinct()) == [(True,)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_manifest_sizes(spark, monkeypatch, n):
    monkeypatch.setattr(manifest, "HEIGHT", 1)
    rows = [(i, f"t\n{i}", "en", "s") for i in range(n)]
    docs = documents(spark, rows)
    want = plain_manifest([tuple(r[c] for c in FIELDS) for r in docs.collect()])
    assert rows_of(manifest.manifest(docs, manifest.tampered_leaf())) == want


def test_manifest_of_nothing(spark):
    assert manifest.manifest(documents(spark, []), manifest.tampered_leaf()).count() == 0


def test_manifest_sql(spark):
    rows = [(*r, *[None] * (4 - len(r)))[:4] for r in cases()] + [(50 + i, f"x\n{i % 7}", "en", "hot") for i in range(40)]
    docs = documents(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.select(*FIELDS).toArrow())
    assert sorted(con.sql(sql.MERKLE).fetchall(), key=SORT) == rows_of(manifest.manifest(docs, manifest.tampered_leaf()))


def test_appender_extends_witnesses():
    """A witness is partial while its subtree is open and grows with each sibling that completes."""
    a = manifest.Appender(2)
    nodes = [bytes([i]) * 32 for i in range(7)]
    for x in nodes[:3]:
        a.append(x)
    assert [len(w) for w in a.witnesses] == [1, 1, 1] and a.witnesses[1][0] == (1, [nodes[0], nodes[2]])
    for x in nodes[3:]:
        a.append(x)
    assert [len(w) for w in a.witnesses] == [1] * 6 + [0]
    root = a.close()
    assert [len(w) for w in a.witnesses] == [2] * 7
    assert {manifest.folded(x, manifest.packed(w)) for x, w in zip(nodes, a.witnesses)} == {root}


# --- SimHash ---


def plain_fingerprint(text):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in cases()] + [(20 + i, " ".join(rng.choices(("Ab", "ÄÖ", "c\x1cd", "e\xa0f", "g h"), k=i))) for i in range(12)]
    got = simhash.digest(simhash.near_duplicates(documents(spark, rows)))
    assert rows_of(got, "doc_id", "fingerprint") == sorted(((i, f"{plain_fingerprint(t):016x}") for i, t in rows), key=SORT)


def test_hash_is_sparks(spark):
    text = "the cat sat on"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == int(simhash.shingle_hashes(text)[0])


def near_groups(fps):
    u = sorted(set(fps))
    return smallest(u, [(a, b) for k, a in enumerate(u) for b in u[:k] if (a ^ b).bit_count() <= 4])


def clustered(rng, centres, around):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(around):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 7)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


def signed(x):
    return x - 2**64 if x >> 63 else x


@pytest.mark.parametrize(("parts", "large"), [(2, 64), (3, 64), (4, 4), (5, 4), (5, 64)])
def test_links(spark, monkeypatch, parts, large):
    """Every number of partitions, with rounds and bands (large = 4) and without, joins what brute force joins."""
    monkeypatch.setattr(simhash, "number_of_parts", lambda total: parts)
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = random.Random(parts)
    fps = [*clustered(rng, 40, 6), *clustered(rng, 2, 250), *(rng.getrandbits(64) for _ in range(200)), 0, 2**64 - 1, 1]
    fps = sorted(set(fps))
    from matricula.llm.components import components

    found = components(simhash.links(spark.createDataFrame([(signed(x),) for x in fps], "fp long")))
    of = {r["node"]: r["component"] for r in found.collect()}
    groups = {}
    for x in fps:
        groups.setdefault(of.get(signed(x), signed(x)), set()).add(x)
    want = {}
    for x, g in near_groups(fps).items():
        want.setdefault(g, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_thresholds():
    """The chosen thresholds keep the pigeonhole sum and cost as little as any other choice."""
    from itertools import product

    rng = np.random.default_rng(2)
    for parts in (2, 3, 5):
        budget = simhash.DIFFER + 1 - parts
        costs = [np.vstack([np.zeros(20), rng.integers(0, 50, (budget + parts, 20)).cumsum(axis=0)]) for _ in range(parts)]
        got = simhash.thresholds(costs, budget)
        assert (got.sum(axis=0) == budget).all()
        for row in range(20):
            cost = lambda ts: sum(c[t + 1, row] for c, t in zip(costs, ts, strict=True))
            assert cost(got[:, row]) == min(cost(ts) for ts in product(range(-1, budget + parts), repeat=parts) if sum(ts) == budget)


def test_expected_counts():
    """Counts by distance are exact for one slice."""
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 9, 64)
    rings = simhash.at_distance(counts, 4)
    for d in range(5):
        assert [sum(int(counts[w]) for w in range(64) if (v ^ w).bit_count() == d) for v in range(64)] == rings[d].tolist()


def test_correlated_bits_stay_together():
    fps = np.random.default_rng(1).integers(0, 2**63, 4000, dtype=np.uint64) & ~np.uint64((1 << 40) | (1 << 9))
    tied = fps | ((fps >> np.uint64(3) & np.uint64(1)) << np.uint64(40)) | ((fps >> np.uint64(3) & np.uint64(1)) << np.uint64(9))
    x = simhash.bit_matrix(tied).astype(float)
    groups = simhash.correlated_groups(x.T @ x, len(tied), 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any({3, 9, 40} <= set(g) for g in groups)


def test_simhash_components(spark):
    rows = [(r[0], r[1]) for r in cases()] + [(60, EN.replace("hill", "hills")), (61, LONG + " end"), (62, LONG), (62, "another text under one id"), (63, "another text under one id"), (64, " ")]
    got = {}
    for r in simhash.near_duplicates(documents(spark, rows)).collect():
        assert (r["component_id"] is None) == (r["doc_id"] is None)
        got[r["doc_id"]] = r["component_id"]
    fps = [(i, plain_fingerprint(t)) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(fps) for b, y in fps[:k] if a == b or (x ^ y).bit_count() <= 4]
    assert {i: g for i, g in got.items() if i is not None} == smallest({i for i, _ in fps}, links)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


# --- ranked search ---


def plain_rank(docs, items, best=50):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: __import__("re").findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low))
    bags = [(i, words(t)) for i, t in docs]
    n_docs, n_words = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    df = {t: sum(t in w for _, w in bags) for t in set().union(*asked.values())}
    out = []
    for item, terms in asked.items():
        scores = []
        for i, w in bags:
            if i is not None and w:
                m = 50 + (50 * len(w) * n_docs) // n_words
                s = sum(int(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 20 * m)) for t in terms if t in w)
                if s > 0:
                    scores.append((-s, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=SORT)


@pytest.mark.parametrize(("part", "block", "best", "pairs"), [(4096, 128, 50, 1_000_000), (16, 4, 3, 1_000_000), (50, 8, 10, 40)])
def test_rank(spark, monkeypatch, part, block, best, pairs):
    monkeypatch.setattr(ranking, "PART", part)
    monkeypatch.setattr(ranking, "BLOCK", block)
    monkeypatch.setattr(ranking, "TERMS_AT_ONCE", pairs)
    rng = random.Random(part)
    vocabulary = [f"w{i}" for i in range(300)]
    draw = lambda k: rng.choices(vocabulary, [1 / (i + 1) for i in range(300)], k=k)
    docs = [(r[0], r[1]) for r in cases()] + [(100 + i, " ".join(draw(rng.randint(1, 60)))) for i in range(250)]
    docs += [(500 + i, "W1 w2. w3") for i in range(30)] + [(7, "w1"), (None, "w1 w2 w3")]
    items = [(1, EN), (2, None), (3, "?!"), (4, "nowhere"), (5, "w1 w2 w2 w3"), (5, "w4 W5"), (None, "w1 w200")] + [(10 + i, " ".join(draw(15))) for i in range(12)]
    made = spark.createDataFrame([(*r, "k", 1, 2) for r in items], "item_id long, text string, term string, n long, score long")
    got = ranking.rank(documents(spark, docs), made, best)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == plain_rank(docs, items, best)


def test_rank_of_nothing(spark):
    some = spark.createDataFrame([(1, "w")], "item_id long, text string")
    assert ranking.rank(documents(spark, []), some).count() == 0
    assert ranking.rank(documents(spark, [(1, "w")]), some.limit(0)).count() == 0
    assert ranking.rank(documents(spark, [(1, None), (2, "")]), some).count() == 0


def test_blocks_are_skipped():
    """A part whose bounds stay below the threshold gives nothing, and one document above it is found alone."""
    import pyarrow as pa

    n = 1000
    terms = [[0, 1] if i == 700 else [0] for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "n": [10] * n, "terms": pa.array(terms, pa.list_(pa.int32())), "counts": pa.array([[1] * len(t) for t in terms], pa.list_(pa.int32()))})
    search = ranking.Search([np.array([0, 1])], np.array([5, 900]), np.array([False, True]), n, 10 * n, 50, np.zeros(1, np.int64))
    part = ranking.Part(search, batch)
    docs, scores = part.at_least(0, 0)
    assert len(docs) == n
    docs, scores = part.at_least(0, int(scores.max()))
    assert docs.tolist() == [700]
    assert not len(part.at_least(0, int(scores.max()) + 1)[0])
