"""License scan, personal data, repeated passages and language identification against plain versions."""

import gc
import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from matricula.llm import jaccard, language, license, pii, suffixes
from messy import DE, EN, cases, documents, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_license(text):
    w = words(text)
    places = sorted((i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())
    line = " " + " ".join(w) + " "
    hits = []
    for rank, rule in enumerate(license.default_rules()):
        if rule.keyword in line:
            hits += [(m.start(), m.end(), rule.priority, rank, rule.label) for m in re.finditer(rf"(?<= )(?:{rule.pattern})(?= )", line)]
    before = lambda a, b: (a[0], -a[1], a[2], a[3]) < (b[0], -b[1], b[2], b[3])
    kept = [b for b in hits if not any(a[0] <= b[0] and a[1] >= b[1] and a[2] <= b[2] and before(a, b) for a in hits)]
    base = sorted({label for _, label in places})
    return (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base), ",".join(sorted({*base, *(k[4] for k in kept)})))


LICENSES = [
    "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance.",
    "MIT License mit license MIT LICENSE; see https://opensource.org/licenses/MIT",
    "GNU General Public License version 3, or the gnu general public license. SPDX-License-Identifier: GPL-3.0-or-later",
    "This work is CC BY 4.0; licensed under a Creative Commons Attribution 4.0 International License. http://creativecommons.org/licenses/by/4.0/",
    "Copyright (c) 2020 Someone. All rights reserved. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "permitted smitten mitlicense ccby", "Mozilla Public License v. 2.0 and the 3-clause BSD license and zlib license, ISC license.",
    "the gnu lesser general public license version 2.1 " * 40,
]


def test_license(spark):
    rows = cases() + [(100 + i, t) for i, t in enumerate(LICENSES)]
    got = rows_of(license.license_labels(documents(spark, rows)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
    want = sorted(((r[0], *plain_license(r[1])) for r in rows), key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))
    assert got == want
    scores = [r["score"] for r in license.license_labels(documents(spark, rows)).collect()]
    assert all(0 <= s <= 1 for s in scores) and max(scores) > 0.9
    assert license.license_labels(documents(spark, [])).count() == 0


def test_license_priority(spark):
    rules = [license.Rule("long", 1, "alpha", "alpha beta gamma"), license.Rule("short", 2, "beta", "beta"), license.Rule("better", 0, "beta", "beta gamma"), license.Rule("side", 2, "gamma", "gamma delta")]
    kept = license.scan(documents(spark, [(1, "alpha beta gamma delta")]), rules).first()["kept"]
    assert [k["label"] for k in kept] == ["long", "better", "side"]


def luhn(digits):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def plain_pii(text):
    text, out = text or "", []
    for rank, (kind, pattern) in enumerate((("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")) or kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


PRIVATE = [
    "write to a.b+c@mail.example.com_x@y.org or 😀 é@x.y.z, not a@b", "10.0.0.255 and 1.2.3.4.5.6.7.8 and 256.1.1.1 and 007.000001.0.0 99999999999999999999.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112; 5500005555555559 5", "call +1 (017) 555-7713 or +49 30 1234567. or +1 2", "@" * 500 + "a" * 3000 + "@",
    "1 2 3 4 5 6 7 8 9 " * 400, "1.2.3.4 " * 300 + "a@b.cd " * 200, 'token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" jane at example dot com', "+" * 50 + "12345678901",
]


def test_personal_data(spark):
    rng = random.Random(3)
    rows = cases() + [(200 + i, t) for i, t in enumerate(PRIVATE)] + [(300 + i, "".join(rng.choice("0123456789.+-@ ab()é_") for _ in range(200))) for i in range(40)]
    found = pii.find(documents(spark, rows))
    got = [(r["doc_id"], r["text"], [tuple(s) for s in r["pii_base"]], [tuple(s) for s in r["pii_spans"]]) for r in found.select("doc_id", "text", "pii_base", "pii_spans").collect()]
    assert len(got) == len(rows)
    for _, text, base, spans in got:
        assert base == plain_pii(text)
        assert set(base) <= set(spans) and spans == sorted(spans)
    digest = {r["doc_id"]: r for r in pii.digest(found).where("doc_id >= 200").collect()}
    for i, text, base, _ in got:
        if i is not None and i >= 200:
            said = ",".join(f"{k}:{a}:{b}" for a, _, b, k in plain_pii(text))
            assert digest[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest() and digest[i]["n_email"] == sum(s[3] == "email" for s in base)
    assert pii.digest(pii.find(documents(spark, []))).count() == 0


def test_frequent_wide_spans_stay(spark):
    wide = ("jane.doe [at] example [dot] com", "bob(at)mail.example.org", "jim at example dot net", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "9b0b3c6a43eb78aa99cbd7049c572391524f37a8", "(017) 555-7713")
    kinds = ("email", "email", "email", "ip", "iban", "iban", "key", "phone")
    rows = [(1000 * j + i, f"row{i} says {w} here") for j, w in enumerate(wide) for i in range(60)]
    rows += [(50_000 + i, f"n{i} 4111 1111 1111 {1000 + i} or a{i}@x.org on 10.0.{i}.1 or 300.{i}.1.1 stood at home. Then it rained at noon. So") for i in range(300)]
    for docs in (documents(spark, rows), documents(spark, [r for r in rows if 6000 <= r[0] < 7000])):
        for i, text, spans in ((r["doc_id"], r["text"], r["pii_spans"]) for r in pii.find(docs).collect()):
            found = {(s["kind"], text[s["start"]:s["end"]]) for s in spans}
            assert not any(k == "email" and " at home" in t for k, t in found)
            if i < 50_000:
                assert (kinds[i // 1000], wide[i // 1000]) in found and all(s["rank"] == pii.KINDS.index(s["kind"]) for s in spans)


def test_iban_check(spark):
    some = [("GB82 WEST 1234 5698 7654 32", True), ("GB82 WEST 1234 5698 7654 33", False), ("DE89370400440532013000", True), ("FR1420041010050500013M02606", True)]
    df = spark.createDataFrame(some, "t string, ok boolean")
    assert df.where(pii._is_iban(df["t"]) != df["ok"]).count() == 0


def test_redaction(spark):
    docs = documents(spark, [(1, "a x@y.org b +1 (017) 555-7713 c"), (2, None), (3, "plain"), (4, "é 10.0.0.1")])
    out = pii.redacted(docs, pii.Boosted())
    assert out.columns == docs.columns
    assert rows_of(out, "doc_id", "text") == [(1, "a [EMAIL] b [PHONE] c"), (2, None), (3, "plain"), (4, "é [IP]")]
    assert out.where("pii_base <> 'b' or row <> 'r' or cuts <> 7").count() == 0


def test_boosting_prefers_what_is_good():
    rows = [{"fold": f, "kind": 2, "digits": d, "others": 0, "marks": 0, "left": 4, "right": 4, "cue": 0, "n": 100, "good": g} for f in (0, 1) for d, g in ((16, 99), (9, 1))]
    model = pii.fit(rows)
    good, bad = (2, 16, 0, 0, 4, 4, 0), (2, 9, 0, 0, 4, 4, 0)
    assert model.margin(good) > 1 and model.margin(bad) < -1 and model.threshold[2] > 0.5
    assert pii.fit([]).threshold == {}


def plain_repeats(rows, length=50):
    """rows: (doc_id, text); the removed bytes of every row as a mask."""
    strings = {}
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for j in range(len(b) - length + 1):
                s = b[j:j + length]
                strings[s] = min(i, strings.get(s, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1) if i is not None else ():
            if strings[b[j:j + length]] < i:
                gone[j:j + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_repeated_passages(spark):
    rng = random.Random(5)
    alphabet = "ab é"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(30)]
    shared = "".join(rng.choice("abcdefgh ") for _ in range(160))
    rows = [r[:2] for r in cases()] + [(100 + i, t) for i, t in enumerate(texts)]
    rows += [(200 + i, texts[i] + shared[i:i + 49 + i % 4] + texts[-i - 1][:80]) for i in range(25)]
    rows += [(300 - i, "=" * (45 + i)) for i in range(12)] + [(400 + i, "ab" * 60 + "x" * i) for i in range(6)] + [(500, shared), (501, shared), (501, shared[::-1]), (20, shared[5:120])]
    got = rows_of(suffixes.remove_repeats(documents(spark, rows)))
    assert got == sorted(plain_repeats(rows), key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))
    assert suffixes.remove_repeats(documents(spark, [])).count() == 0


def test_repeated_passages_in_pieces(spark, monkeypatch):
    import numpy as np

    rng = random.Random(6)
    monkeypatch.setattr(suffixes, "PIECE", 300)
    long = bytes(rng.choice(b"abcd") for _ in range(5000))
    found = {}
    for data, begins, number, offset in suffixes.pieces([long]):
        first, stop, _, _, part, prints = suffixes.samples(data, begins)
        at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, stop)])
        for place, name in zip((at + np.repeat((offset - begins)[part], stop - first + 1)).tolist(), prints.of(at, at + 50).tolist()):
            found.setdefault(place, []).append(name)
    assert sorted(found) == list(range(len(long) - 49)) and all(len(v) == 1 for v in found.values())
    by_string = {}
    for place, (name,) in found.items():
        assert by_string.setdefault(long[place:place + 50], name) == name


def test_kept_text(spark):
    docs = documents(spark, [(1, EN), (2, "start " + EN + " end of it"), (3, EN), (4, None)])
    assert [(i, bytes(k).decode()) for i, k in rows_of(suffixes.remove_repeats(docs, texts_out=True), "doc_id", "kept")] == [(1, EN), (2, "start  end of it"), (3, ""), (4, "")]


def cuts(word, pieces):
    if not word:
        return [[]]
    return [[word[:k], *rest] for k in range(1, len(word) + 1) if word[:k] in pieces for rest in cuts(word[k:], pieces)]


def test_forward_sums_all_segmentations():
    import numpy as np

    pieces = ["^a", "^", "a", "b", "ab", "ba", "abb", "^ab"]
    trie = language.Trie.of(pieces)
    rng = np.random.default_rng(1)
    chances = rng.random((len(pieces), 2))
    some = ["a", "ab", "abba", "babab", "zab"]
    got = language.word_chances(some, trie, trie.lookup(), chances, np.zeros(2))
    for word, row in zip(some, got, strict=True):
        for k in range(2):
            want = sum(np.prod([chances[pieces.index(p), k] for p in cut]) for cut in cuts("^" + word, set(pieces)))
            assert np.exp(row[k]) == pytest.approx(want, rel=1e-9, abs=1e-299)


def test_language(spark):
    rng = random.Random(2)
    rows = [(1000 + i, " ".join(rng.choices((EN if i % 2 else DE).split(), k=40)), "en" if i % 2 else "de") for i in range(80)]
    out = language.identify(documents(spark, cases() + rows))
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == len(cases()) + len(rows)
    for i, _, lang in rows:
        assert got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1
    assert {got[i]["lang_pred"] for i in (3, 4, 5, 11)} == {"und"} and any(got[i]["held_out"] for i, _, _ in rows)
    assert [r["lang_pred"] for r in language.identify(documents(spark, [(1, EN, None)])).collect()] == ["und"]
    assert language.identify(documents(spark, [])).count() == 0
    kept = language.known(documents(spark, cases() + rows))
    assert kept.columns == documents(spark, []).columns and {3, 4, 5, 11}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_foreign_text_is_rejected(spark, raw_dir):
    """Other scripts and random letters go, short and plain texts of the learned languages stay."""
    docs = spark.read.parquet(f"{raw_dir}/documents.parquet").select("doc_id", "text", "lang")
    foreign = ["\u8fd9\u662f\u4e00\u4e2a\u5173\u4e8e\u5929\u6c14\u7684\u4e2d\u6587\u53e5\u5b50", "\u0421\u0435\u0433\u043e\u0434\u043d\u044f \u0445\u043e\u0440\u043e\u0448\u0430\u044f \u043f\u043e\u0433\u043e\u0434\u0430", "xqzvk jwqpf zzkqx vbnmq wrtyp ghjkl qqxz"]
    short = ["hello", "the cat sat on the mat", "der Hund", "el perro", "le chat dort", "x"]
    more = spark.createDataFrame([(900_000 + i, t, None) for i, t in enumerate(foreign + short)], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language.known(docs.unionByName(more)).where("doc_id >= 900000").collect()}
    assert not kept & {900_000 + i for i in range(len(foreign))}
    # "hello" and "x" are in several languages as likely as in any other; what one language claims stays.
    assert kept >= {900_000 + len(foreign) + i for i, t in enumerate(short) if t not in ("hello", "x")}
    assert all(r["lang_pred"] != "und" for r in language.identify(docs.unionByName(more)).where("doc_id >= 900000").collect())


def test_every_language_keeps_its_words(spark):
    """The bound of words is one per language: names late in the alphabet lose nothing to others."""
    rows = [(i, f"aa{chr(97 + i)} b{chr(97 + i)}b", "en") for i in range(20)] + [(100 + i, f"zu{chr(97 + i)}", "zz") for i in range(20)]
    model = language.learn(documents(spark, rows), most_words=5)
    assert model.languages == ["en", "zz"] and not np.allclose(model.chances[:, 1], model.chances[0, 1])


def test_words_stay_in_the_tasks(spark, monkeypatch):
    """The driver fits nothing: it gets each language's probabilities, which are those of a fit on all of its words."""
    rows = [(i, f"tree aa{chr(97 + i)}", "en") for i in range(20)] + [(100 + i, f"baum zu{chr(97 + i)}", "de") for i in range(20)] + [(200, "12 34", "zz"), (201, "56", "zz"), (202, "78", "zz")]
    seen, fit = [], language.fit
    with monkeypatch.context() as patched:
        patched.setattr(language, "fit", lambda counts, *rest: seen.extend(counts) or fit(counts, *rest))
        model = language.learn(documents(spark, rows))
    assert seen == [] and model.languages == ["de", "en", "zz"]
    learned = documents(spark, rows).where(~language.held_out(F.col("doc_id"))).collect()
    counts = Counter((r["lang"], w) for r in learned for w in language.WORDS.findall(r["text"]))
    want = fit(sorted(((lang, w, n) for (lang, w), n in counts.items()), key=lambda c: (c[0], -c[2], c[1])), dict.fromkeys(model.languages, 1), language.pieces())
    assert np.array_equal(model.chances, want.chances) and model.letters == {c for _, w in counts for c in w}
    assert model.least[2] == -language.LEAST and (model.least < 0).all()


def test_language_held_out_accuracy(spark, raw_dir):
    docs = spark.read.parquet(f"{raw_dir}/documents.parquet")
    both = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").selectExpr("avg(int(lang = lang_pred)) a", "count(*) n").first()
    assert both["n"] > 20 and both["a"] >= 0.95


def test_numbered_words_are_freed_at_once():
    """Batch after batch, a worker's memory must not wait for the collector of cycles."""
    model = language.fit([("en", "tree", 3)], {"en": 1}, ["^", "e", "r", "t"])
    lookup = model.trie.lookup()
    held = lambda: sum(isinstance(o, defaultdict) for o in gc.get_objects())
    gc.collect()
    gc.disable()
    try:
        before = held()
        for _ in range(3):
            jaccard.shingle_sets(["a tree is a tree", None], 2)
            language.text_scores(["a tree is a tree", None], model, lookup)
        assert held() == before
    finally:
        gc.enable()


def test_language_works_on_few_words_at_once():
    pieces = sorted({"^", *"abcdefghijklmnopqrstuvwxyz", *(a + b for a in "abcdefghij" for b in "abcdefghij")})
    chances = np.full((len(pieces), 8), 1.0 / len(pieces))
    model = language.Model([f"l{i}" for i in range(8)], language.Trie.of(pieces), chances, np.full(8, 1e-7), np.zeros(8))
    random.seed(3)
    text = " ".join("".join(random.choices("abcdefghij", k=12)) for _ in range(20_000))
    lookup = model.trie.lookup()
    language.text_scores([text[:50]], model, lookup)
    tracemalloc.start()
    try:
        names, _, _ = language.text_scores([text], model, lookup)
        assert names == ["l0"] and tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("made", [language.known, language.identify])
def test_language_gets_small_batches(spark, made):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for now, then in (("10000", language.ARROW_ROWS), ("0", language.ARROW_ROWS), ("7", 7)):
            spark.conf.set(name, now)
            made(documents(spark, [(1, EN, "en")]))
            assert int(spark.conf.get(name)) == then
    finally:
        spark.conf.set(name, before)
