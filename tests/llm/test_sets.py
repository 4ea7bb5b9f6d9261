"""Near-duplicate join, decontamination, neighbours, mixing, URL filter and toxicity against plain versions."""

import math
import random
import re

import pytest

from matricula.llm import components, contamination, jaccard, mixing, neighbours, toxicity, urls
from messy import EN, cases, documents, rows_of

SORT = lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def smallest(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200 + i) for i in range(50)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(1, 1), (None, 5)]
    clean = [(a, b) for a, b in edges if a is not None and a != b]
    want = smallest({x for e in clean for x in e}, clean)
    got = components.components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(rows_of(got)) == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def plain_groups(rows, size, percent):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t, size))
    items = [(i, s) for i, many in sets.items() for s in many if s]
    links = [(a, b) for k, (a, x) in enumerate(items) for b, y in items[:k] if a == b or 100 * len(x & y) >= percent * len(x | y)]
    group = smallest(sets, links)
    return sorted(((i, len(shingles(t, size)), group.get(i)) for i, t in rows), key=SORT)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_near_duplicates(spark, size, percent):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(r[0], r[1]) for r in cases()]
    for g in range(30):
        base = rng.choices(vocabulary, k=rng.choice((3, 6, 9, 14, 30, 80, 200)))
        for c in range(rng.choice((1, 2, 4, 9))):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((1000 + 20 * g + c, " ".join(copy) + " tail" * rng.choice((0, 0, 1))))
    common = rng.choices(vocabulary, k=60)
    rows += [(3000 + i, " ".join(common + rng.choices(vocabulary, k=rng.choice((2, 8, 40, 60))))) for i in range(40)] + [(3000, "another text under a known id")]
    got = jaccard.near_duplicates(documents(spark, rows), jaccard.Rule(size, percent))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, size, percent)


@pytest.mark.parametrize("earliest", [1, 8])
def test_pairs_of_many_shared_runs(spark, monkeypatch, earliest):
    """Groups whose copies lie on both sides of the threshold and share many bands; the list of first keys is short or long."""
    monkeypatch.setattr(jaccard, "EARLIEST", earliest)
    rng = random.Random(earliest)
    rows = []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(150)]
        for c in range(40):
            copy = list(base)
            for at in rng.sample(range(150), rng.randrange(7)):
                copy[at] = f"x{rng.randrange(1000)}"
            rows.append((100 * g + c, " ".join(copy)))
    got = jaccard.near_duplicates(documents(spark, rows), jaccard.Rule(5, 80))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, 5, 80)


def test_near_duplicates_of_nothing(spark):
    assert jaccard.near_duplicates(documents(spark, [])).count() == 0


def test_band_bound():
    """Sets within the allowed difference share a key; the sizes next to every class border are among them."""
    import numpy as np

    rng = np.random.default_rng(4)
    rule = jaccard.Rule(4, 85)
    for n in [*range(6, 40), 63, 64, 95, 97, 144, 300, 301]:
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for extra in range(rule.largest(n) - n + 1):
            gone = 0
            while 100 * (n - gone - 1) >= 85 * (n + extra):
                gone += 1
            b = np.unique(np.r_[a[gone:], rng.integers(0, 1 << 63, extra, dtype=np.uint64)])
            if len(b) and (extra or gone):
                assert np.intersect1d(jaccard.band_keys(a, rule) >> np.uint64(12), jaccard.band_keys(b, rule) >> np.uint64(12)).size, (n, extra, gone)


def test_wide_sketches_bound_the_difference():
    """Folded to one length, the Hamming distance never exceeds the symmetric difference, and far sets are refused."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(6)
    rule = jaccard.Rule(4, 85)
    refused = 0
    for n, m, same in ((3000, 3000, 2800), (3000, 2600, 2590), (900, 1100, 850), (5000, 5200, 100), (700, 800, 0)):
        shared = rng.integers(0, 1 << 63, same, dtype=np.uint64)
        x, y = (np.unique(np.r_[shared, rng.integers(0, 1 << 63, k - same, dtype=np.uint64)]) for k in (n, m))
        batch = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "x_wide": [jaccard.wide_sketch(x, rule)], "y_wide": [jaccard.wide_sketch(y, rule)], "x_n": [len(x)], "y_n": [len(y)]})
        (out,) = jaccard._refined(iter([batch]), rule)
        common = len(np.intersect1d(x, y))
        linked = 100 * common >= 85 * (len(x) + len(y) - common)
        assert out["may"][0].as_py() or not linked
        assert out["least"][0].as_py() <= 1 - common / (len(x) + len(y) - common) + 1e-12
        refused += not out["may"][0].as_py()
    assert refused >= 2 and jaccard.wide_sketch(x[:100], rule) == b""


def test_long_sketches_bound_the_difference(spark):
    """Compared in Spark, of equal length and of twice the length; sets too small for one give no bound."""
    import numpy as np

    rng = np.random.default_rng(8)
    rule = jaccard.Rule(4, 85)
    rows, far = [], []
    for n, m, same in ((3000, 3000, 2800), (1560, 1600, 1500), (1500, 1700, 0), (4000, 4100, 2000), (400, 420, 0), (900, 1100, 0)):
        shared = rng.integers(0, 1 << 63, same, dtype=np.uint64)
        x, y = (np.unique(np.r_[shared, rng.integers(0, 1 << 63, k - same, dtype=np.uint64)]) for k in (n, m))
        rows.append(tuple(jaccard.long_sketch(jaccard.wide_sketch(s, rule), len(s)) for s in (x, y)))
        far.append((len(np.setxor1d(x, y)), n + m, same))
    assert any(len(x) != len(y) and x and y for x, y in rows)
    found = [r[0] for r in spark.createDataFrame(rows, "x_long array<long>, y_long array<long>").select(jaccard._long_bits()).collect()]
    assert all(bits <= d for bits, (d, _, _) in zip(found, far, strict=True))
    assert all(bits * 185 > both * 15 for bits, (_, both, same) in zip(found, far, strict=True) if both > 2500 and same * 3 < both)
    assert found[-2:] == [0, 0]


def test_near_duplicates_of_large_sets(spark):
    rng = random.Random(77)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows = []
    for g in range(8):
        base = rng.choices(vocabulary, k=rng.choice((500, 1500, 4000)))
        for c in range(4):
            copy = list(base)
            for _ in range(rng.choice((1, 10, 30, 60))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((10 * g + c, " ".join(copy)))
    passage = rng.choices(vocabulary, k=1200)
    rows += [(200 + i, " ".join(passage + rng.choices(vocabulary, k=900 + 40 * i))) for i in range(12)] + [(200, "another")]
    got = jaccard.near_duplicates(documents(spark, rows), jaccard.Rule(4, 85))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == plain_groups(rows, 4, 85)


def plain_hits(docs, bench, size=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = {}
    for item, t in bench:
        w = word(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    lengths = {len(w) for w in wins}
    per_id = {}
    for i, t in docs:
        w, (hit, items) = word(t), per_id.setdefault(i, (set(), set()))
        for n in lengths:
            for p in range(len(w) - n + 1):
                found = wins.get(tuple(w[p:p + n]))
                if found:
                    hit.update(range(p, p + n))
                    items.update(found)
    return sorted(((i, len(word(t)), len(per_id[i][0]) if i is not None else 0, len(per_id[i][1]) if i is not None else 0) for i, t in docs), key=SORT)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("bound", [200_000, 3])
def test_decontamination(spark, monkeypatch, bound):
    monkeypatch.setattr(contamination, "BROADCAST_TERMS", bound)
    rng = random.Random(8)
    vocabulary = [f"t{i}" for i in range(12)]
    bench = [(1, EN), (2, "short item"), (3, None), (4, "?!"), (5, " ".join(rng.choices(vocabulary, k=25))), (6, EN), (7, "zzz never seen anywhere")]
    rows = [(r[0], r[1]) for r in cases()] + [(50 + i, " ".join(rng.choices(vocabulary, k=80)) + (f" {bench[4][1]} " if i % 5 == 0 else "") + ("Short-Item" if i % 7 == 0 else "")) for i in range(30)]
    rows += [(90, EN[20:90]), (91, EN + " " + EN), (92, EN.upper())]
    out = contamination.judge(documents(spark, rows), benchmark(spark, bench))
    want = plain_hits(rows, bench)
    assert rows_of(out, "doc_id", "n_words", "n_hit", "n_items") == want
    dirty = {r[0] for r in want if r[2]}
    kept = contamination.clean(documents(spark, rows), benchmark(spark, bench))
    assert kept.columns == documents(spark, []).columns
    assert {r["doc_id"] for r in kept.collect()} - {None} == {r[0] for r in rows} - dirty - {None}
    assert contamination.judge(documents(spark, rows), benchmark(spark, [])).where("contaminated").count() == 0


def plain_near(docs, bench, size=10):
    """Per document the places of a window's rarest words with 80 % of the window's different words within reach."""
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = {tuple(w[i:i + size]) for _, t in bench if (w := word(t)) for i in range(max(1, len(w) - size + 1))}
    count = {}
    for _, t in docs:
        for x in word(t):
            count[x] = count.get(x, 0) + 1
    out = {}
    for i, t in docs:
        w, places = word(t), out.setdefault(i, set())
        for win in wins:
            different = set(win)
            rare = sorted(different, key=lambda x: (count.get(x, 0), x.encode()))[: len(different) - math.ceil(0.8 * len(different)) + 1]
            places.update(p for p, x in enumerate(w) if x in rare and len(different & set(w[max(0, p - size + 1):p + size])) >= 0.8 * len(different))
    return {i: len(p) for i, p in out.items()}


def test_near_places(spark):
    rng = random.Random(21)
    vocabulary = [f"t{i}" for i in range(40)]
    bench = [(1, " ".join(rng.choices(vocabulary, k=30))), (2, "Short one"), (3, None), (4, EN)]
    changed = lambda t, k: " ".join("zz" if i % k == 3 else x for i, x in enumerate(t.split()))
    rows = [(i, " ".join(rng.choices(vocabulary, k=90)) + " " + rng.choice((bench[0][1], changed(bench[0][1], 9), changed(EN, 8), "one more short"))) for i in range(25)] + [(40, None), (41, "")]
    want = plain_near(rows, bench)
    out = contamination.judge(documents(spark, rows), benchmark(spark, bench))
    assert dict(rows_of(out, "doc_id", "n_near")) == want
    least = sorted(want.values())[-6]
    exact = {r["doc_id"] for r in out.where("contaminated").collect()}
    kept = contamination.clean(documents(spark, rows), benchmark(spark, bench), near_places=least)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, n in want.items() if n < least} - exact


def test_proximity(spark):
    docs = documents(spark, [(1, "one two three four five six seven eight nine ten"), (2, "ten nine eight seven six five four three two one"), (3, "one two elsewhere")])
    exact, near = contamination.find(docs, benchmark(spark, [(1, "one two three four five six seven eight nine ten")]))
    assert {r["doc_id"] for r in exact.collect()} == {1} and {r["doc_id"] for r in near.collect()} == {1, 2}


def test_proximity_misses_no_stretch(spark):
    rng = random.Random(9)
    item = [f"w{i}" for i in range(14)]
    rows = [(1, "w0 w1 w2 w3 x w5 w6 w7 w8 w9"), (2, "common"), (3, "x w1 w2 w3 w4 w5 w6 w7 w8 y"), (4, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13")]
    rows += [(10 + i, " ".join(rng.choice(item + ["x", "y"]) for _ in range(40))) for i in range(30)]
    rows += [(50 + i, " ".join(rng.sample(item, 14))) for i in range(20)]
    bench = [(1, " ".join(item)), (2, "a b a b w3"), (3, "w1 w1 w1 x unseen")]
    windows = [set(w[i:i + 10]) for w in (t.split() for _, t in bench) for i in range(max(1, len(w) - 9))]
    sizes = [min(10, len(t.split())) for _, t in bench for _ in range(max(1, len(t.split()) - 9))]
    want = {d for d, t in rows for win, size in zip(windows, sizes, strict=True) for i in range(len(t.split())) if len(win & set(t.split()[i:i + size])) >= 0.8 * len(win)}
    _, near = contamination.find(documents(spark, rows), benchmark(spark, bench))
    got = {(r["doc_id"], r["place"]) for r in near.collect()}
    assert {1, 3, 4} <= want <= {d for d, _ in got}
    for d, place in got:
        around = set(dict(rows)[d].split()[max(0, place - 9):place + 10])
        assert any(len(win & around) >= 0.8 * len(win) for win in windows)


def test_query_searches_proximity(spark, raw_dir, monkeypatch):
    from matricula.llm import catalog

    kept, keep = {}, contamination.stored
    monkeypatch.setattr(contamination, "stored", lambda df, label: kept.setdefault(label, keep(df, label)))
    rows = catalog.op8_decontaminate(spark, raw_dir)
    hits = {r["doc_id"] for r in rows.where("contaminated").collect()}
    assert {"doc_id", "n_near"} == set(kept["near"].columns) and hits <= {r["doc_id"] for r in kept["near"].collect()}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    data = rng.normal(size=(700, 24)).astype(np.float32)
    data[300:] = data[rng.integers(0, 30, 400)] + 0.2 * rng.normal(size=(400, 24)).astype(np.float32)
    data[500:620] = data[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(data)]
    odd = [(7000, None, 0), (7100, [0.0] * 24, 0), (7200, [float("nan")] * 24, 0), (7300, [None] * 24, 0), (7400, [1.0, 2.0], 0), (7500, [], 0), (None, data[0].tolist(), 0), (0, data[0].tolist(), 0)]
    got = neighbours.nearest(vectors(spark, rows + odd)).collect()
    right = total = 0
    for q in range(0, 700, 100):
        gap = np.sqrt(((data.astype(float) - data[q].astype(float)) ** 2).sum(1))
        gap[q] = np.inf
        want = np.lexsort((np.arange(700), gap))[:10]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11)) and [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        assert all(r["score"] == pytest.approx(gap[r["vec_id"]], rel=1e-12) for r in mine)
        right, total = right + len({r["vec_id"] for r in mine} & set(want.tolist())), total + 10
    assert right / total >= 0.9 and {r["query_id"] for r in got} == set(range(0, 700, 100))
    few = neighbours.nearest(vectors(spark, rows[:1] + rows[100:104])).collect()
    assert sorted(r["vec_id"] for r in few if r["query_id"] == 0) == [100, 101, 102, 103]
    assert neighbours.nearest(vectors(spark, [])).count() == 0


def test_full_buckets_are_dealt_by_their_counts(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    data = rng.normal(size=(1500, 16)).astype(np.float32)
    data[500:] = data[0] + 0.01 * rng.normal(size=(1000, 16)).astype(np.float32)
    rows = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(data)])
    whole = rows_of(neighbours.nearest(rows))
    monkeypatch.setattr(neighbours, "PART", 50 * 16)
    monkeypatch.setattr(neighbours, "ASKED", 20 * 16)
    assert rows_of(neighbours.nearest(rows)) == whole
    wide = rows.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    asked, held = neighbours._dealt(neighbours.index(wide), wide.where("vec_id % 5 = 0").withColumnRenamed("vec_id", "query_id"), 2, 3)
    assert held.groupBy("table", "bucket").agg(F.countDistinct("ids").alias("n")).where("n >= 1000").count() > 0
    assert held.groupBy(*neighbours.KEYS).count().agg(F.max("count")).first()[0] < 100
    assert asked.groupBy(*neighbours.KEYS).count().agg(F.max("count")).first()[0] < 60


def test_neighbours_of_extreme_norms(spark):
    """Vectors whose squares leave the range of doubles hash by their direction and have exact distances."""
    import numpy as np

    rng = np.random.default_rng(12)
    base = rng.normal(size=(60, 8))
    rows = [(i, (base[i % 60] * scale).tolist()) for k, scale in enumerate((1e200, 1.0, 1e-200)) for i in range(60 * k, 60 * k + 60)] + [(200, (base[0] * 1e200).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = {}
    for r in neighbours.search(frame, frame.where("vec_id IN (0, 100, 150)"), k=200, probes=16).collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    vectors_of = dict(rows)
    for q in (0, 100, 150):
        want = sorted((math.dist(vectors_of[q], v), i) for i, v in rows if i != q)
        assert len(got[q]) == len(want) and sorted(got[q]) == got[q]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in want], rel=1e-12)
    assert got[0][0] == (0.0, 200) and all(0 < s < 1e-190 for s, i in got[150] if i in range(120, 180))
    for scale in (1e200, 1.0, 1e-200):
        assert (neighbours.buckets(neighbours.rotated(base * scale, 0, 1), 3) == neighbours.buckets(neighbours.rotated(base, 0, 1), 3)).all()


def test_hadamard():
    import numpy as np

    h = np.array([[1.0]])
    while len(h) < 8:
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(0).normal(size=(5, 8))
    assert np.allclose(neighbours.hadamard(x), x @ h.T)


def test_shares(spark):
    def budgets(total, children):
        df = spark.createDataFrame([(n, w, c, total) for n, w, c in children], "name string, weight int, cap long, parent_budget long")
        return dict(rows_of(mixing.shares(df, [], "name"), "name", "budget"))

    assert budgets(100, [("a", 1, 1000), ("b", 3, 1000)]) == {"a": 25, "b": 75}
    assert budgets(100, [("a", 1, 1000), ("b", 3, 10)]) == {"a": 90, "b": 10}
    assert budgets(30, [("a", 1, 10), ("b", 1, 10), ("c", 1, 10)]) == {"a": 10, "b": 10, "c": 10}
    assert sum(budgets(100, [("a", 1, 1000), ("b", 1, 1000), ("c", 1, 1000)]).values()) == 100
    assert budgets(50, [("a", 0, 100), ("b", 1, 20)]) == {"a": 30, "b": 20}
    assert budgets(0, [("a", 1, 5), ("b", 2, 5)]) == {"a": 0, "b": 0}


def test_shortage_goes_to_siblings_before_ancestors(spark):
    sizes = spark.createDataFrame([("d1", "en", "s1", 10), ("d1", "en", "s2", 100), ("d1", "de", "s3", 100), ("d2", "en", "s4", 100)], "domain string, lang string, source string, n_tokens long")
    weights = spark.createDataFrame([], "path string, weight int")
    out = {r["source"]: r["budget"] for r in mixing.leaf_budgets(sizes, weights, 160, 1).collect()}
    assert out == {"s1": 10, "s2": 30, "s3": 40, "s4": 80}


def test_mix(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    rows = [(r[0], r[1], r[2], r[3]) for r in cases()] + [(100 + i, " ".join(["w"] * rng.randint(1, 30)), rng.choice(("en", "de")), rng.choice(("src1", "src2", "src3"))) for i in range(200)]
    weights = spark.createDataFrame([("a", 3), ("a/en", 2)], "path string, weight int")
    domain = F.when(F.col("source") == "src1", "a").otherwise("b")
    pick = lambda: mixing.mix(documents(spark, rows), weights, domain, total=0.7, epochs=2, seed=1)
    got = pick().collect()
    assert rows_of(pick()) == sorted((tuple(r) for r in got), key=SORT)
    size = {}
    for i, t, lang, source in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        if n:
            size.setdefault(("a" if source == "src1" else "b", lang or "none", source or "none"), []).append((i, n))
    taken = {}
    for r in got:
        taken.setdefault((r["domain"], r["lang"], r["source"]), []).append(r)
    for leaf, mine in taken.items():
        total, budget, whole = sum(n for _, n in size[leaf]), mine[0]["budget"], mine[0]["budget"] // sum(n for _, n in size[leaf])
        used = sum(r["n_tokens"] for r in mine)
        assert budget <= used < budget + 2 * max(n for _, n in size[leaf]) + 1 and {r["epoch"] for r in mine} <= set(range(whole + 1)) and total * 2 >= budget
    assert mixing.mix(documents(spark, []), weights, domain).count() == 0


URLS = [
    "http://a.example.net/en/12", "http://EXAMPLE.net/en/5?x=1", "https://x.example.net/fr/9", "https://example.com/de/1#t", "http://shop.example.com/de/", "http://shop.example.com/de",
    "http://w.org/fr/x", "http://w.org/fr", "http://net/", "http://net", "http://notexample.com/de/1", "no scheme", "", None, "x://", "x://h", "x:///p", "x://h?q=/net/", "a://b://c/d", "http://é.net/ü",
]


def plain_rule(host, path):
    best = None
    for verdict, rule in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(100 + i, f"http://big.example.com/{'de' if i % 3 else 'en'}/{i}/x{i}y") for i in range(120)] + [(0, URLS[0]), (None, URLS[2])]
    out = urls.judge(spark.createDataFrame([(i, u, 1, "t") for i, u in rows], "page_id long, url string, n long, template string")).collect()
    assert len(out) == len(rows)
    said = {i: u for i, u in rows if i is not None}
    for r in out:
        url = said.get(r["page_id"], URLS[2])
        m = re.match(r"(?s)(?:.*?)://([^/?#]*)([^?#]*)", url or "")
        host, path = (m.group(1).translate(LOWER), m.group(2)) if m else ("", "")
        assert (r["host"], r["path"]) == (host, path)
        rule = plain_rule(host, path)
        assert r["rule"] == (rule[1] if rule else None) and r["verdict"] in ("allow", "block") and (not rule or r["verdict"] == rule[0])
    assert len({r["template"] for r in out if r["page_id"] is not None and r["page_id"] >= 100}) < 20
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_templates_are_judged_by_their_labels(spark):
    paths = [("h", f"/bad/{w}{i}", 1, 1, 0) for i in range(30) for w in "xy"] + [("h", "/bad/x77", 1, 0, 0), ("h", "/good/1", 1, 0, 1), ("h", "/good/2", 1, 0, 0)]
    tree = urls.templates(spark.createDataFrame(paths, "host string, path string, n long, n_block long, n_allow long"))
    at = {r["path"]: r["template"] for r in tree.collect()}
    assert at["/bad/x77"] == at["/bad/x1"] and at["/good/1"] == at["/good/2"] != at["/bad/x1"]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int")


def test_toxicity(spark):
    rng = random.Random(9)
    plain, bad = EN.split(), ["vile", "nasty", "rotten"]
    rows, marks = [], []
    for i in range(300):
        sentences = [" ".join(rng.choices(plain, k=8)) for _ in range(6)]
        if i % 3 == 0:
            for k in rng.sample(range(6), 2):
                sentences[k] = " ".join([*rng.choices(plain, k=6), rng.choice(bad), rng.choice(plain)])
        rows.append((1000 + i, ". ".join(sentences) + "."))
        marks.append((1000 + i, int(i % 3 == 0)))
    docs, labels = documents(spark, [(r[0], r[1]) for r in cases()] + rows), labelled(spark, [*marks, marks[0], (None, 1), (5, None), (99999, 1)])
    got = {r["doc_id"]: r for r in toxicity.judge(docs, labels).collect()}
    held = [(got[i]["score"], y) for i, y in marks if got[i]["held_out"]]
    assert len(held) > 50 and sum((s >= 0.7) == bool(y) for s, y in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values()) and got[3]["score"] == got[4]["score"] == 0
    assert toxicity.judge(docs, labels).count() == docs.count()
    found = toxicity.offending(docs, toxicity.learn(docs, labels)).collect()
    text = dict(rows)
    assert found and all(text[r["doc_id"]][r["start"]:r["end"]] == r["sentence"] and any(b in r["sentence"] for b in bad) for r in found if r["doc_id"] in text)
    assert not any(r["predicted"] for r in toxicity.judge(docs, labelled(spark, [])).collect())
    assert toxicity.judge(documents(spark, []), labels).count() == 0


def test_noisy_or():
    import numpy as np

    model = toxicity.Model(["vile"], np.array([9.0]), -6.0)
    one = 1 / (1 + math.exp(6.0))
    bad = 1 / (1 + math.exp(-3.0))
    scores, _ = toxicity.score_texts(["fine. fine. vile", None, ""], model)
    assert scores[0] == pytest.approx(1 - (1 - one) ** 2 * (1 - bad)) and scores[1] == scores[2] == 0
