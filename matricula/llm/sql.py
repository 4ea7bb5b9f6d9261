"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
BREAK = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def word_list(text: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), {LETTERS}), {BREAK}), lambda x: x <> '')"


def decontaminate_ctes(docs: str = "documents") -> str:
    """CTEs up to `found` (doc_id, place, size, item_id): every occurrence of every window."""
    return f"""
    bench AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {word_list('text')} AS w FROM benchmark),
    bench_at AS (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bench WHERE len(w) > 0),
    wins AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win FROM bench_at),
    doc_words AS (SELECT doc_id, {word_list('text')} AS w FROM {docs}),
    doc_at AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS place FROM doc_words CROSS JOIN (SELECT DISTINCT size FROM wins) WHERE len(w) >= size),
    found AS (SELECT DISTINCT doc_id, place, a.size, item_id FROM doc_at AS a JOIN wins ON wins.size = a.size AND wins.win = array_to_string(list_slice(w, place, place + a.size - 1), ' '))"""


DECONTAMINATE = f"""
WITH {decontaminate_ctes()},
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(place, place + size)) AS word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id),
sets AS (SELECT DISTINCT win, list_distinct(string_split(win, ' ')) AS words FROM wins),
tokens AS (SELECT doc_id, w, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS place FROM doc_words),
asked AS (SELECT win, words, unnest(words) AS term FROM sets),
counts AS (SELECT term, count(*) AS n FROM tokens WHERE term IN (SELECT term FROM asked) GROUP BY term),
ranked AS (SELECT win, words, term, row_number() OVER (PARTITION BY win ORDER BY coalesce(n, 0), term) AS rank FROM asked LEFT JOIN counts USING (term)),
anchors AS (SELECT * FROM ranked WHERE rank <= len(words) - ceil(CAST(0.8 AS DOUBLE) * len(words)) + 1),
near AS (SELECT doc_id, count(DISTINCT place) AS n_near FROM tokens JOIN anchors USING (term)
    WHERE len(list_intersect(words, list_slice(w, greatest(1, place - 9), place + 9))) >= CAST(0.8 AS DOUBLE) * len(words) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)"""

LEVELS = ("domain", "lang", "source")


def _level(depth: int) -> str:
    """CTEs that share budgets among the children at one level of the tree."""
    path, above, name = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[: depth - 1]), LEVELS[depth - 1]
    part = f"PARTITION BY {above}" if above else ""
    upto = f"{part} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    before = f"{part} ORDER BY ratio, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    whole = f"PARTITION BY {above}" if above else ""
    parent = f"JOIN b{depth - 1} USING ({above})" if above else "CROSS JOIN b0"
    key = " || '/' || ".join(LEVELS[:depth])
    return f"""
    n{depth} AS (SELECT {path}, sum(n_tokens)::HUGEINT AS once, 3 * sum(n_tokens)::HUGEINT AS cap FROM sizes GROUP BY {path}),
    w{depth} AS (SELECT n.*, budget AS parent_budget, coalesce(weight, 1)::HUGEINT AS w, cap::DOUBLE / coalesce(weight, 1) AS ratio FROM n{depth} AS n {parent} LEFT JOIN weights ON path = {key}),
    r{depth} AS (SELECT *, parent_budget - coalesce(sum(cap) OVER ({before}), 0) AS left_budget, sum(w) OVER ({whole}) - coalesce(sum(w) OVER ({before}), 0) AS left_weight FROM w{depth}),
    f{depth} AS (SELECT *, min(CASE WHEN cap * left_weight <= left_budget * w THEN 1 ELSE 0 END) OVER ({upto}) AS is_full FROM r{depth}),
    o{depth} AS (SELECT *, parent_budget - sum(cap * is_full) OVER ({whole}) AS rest, sum(w * (1 - is_full)) OVER ({whole}) AS open_weight, sum(w * (1 - is_full)) OVER ({upto}) AS upto FROM f{depth}),
    b{depth} AS (SELECT {path}, once, CASE WHEN is_full = 1 THEN cap ELSE (rest * upto) // open_weight - (rest * (upto - w)) // open_weight END::HUGEINT AS budget FROM o{depth})"""


def mix(docs: str = "documents") -> str:
    return f"""
    WITH weights(path, weight) AS (VALUES ('d0', 4), ('d1', 3), ('d2', 2), ('d3', 1), ('d0/en', 3), ('d1/en', 2), ('d2/en', 2), ('d0/es', 2)),
    rows_ AS (SELECT doc_id, 'd' || (coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % 4) AS domain, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
              md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS own,
              CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS n_tokens FROM {docs}),
    sizes AS (SELECT domain, lang, source, sum(n_tokens) AS n_tokens FROM rows_ WHERE n_tokens > 0 GROUP BY domain, lang, source),
    b0 AS (SELECT least(3 * sum(n_tokens), floor(CAST(0.6 AS DOUBLE) * sum(n_tokens)))::HUGEINT AS budget FROM sizes),
    {','.join(_level(d) for d in (1, 2, 3))},
    placed AS (SELECT r.*, budget, budget // once AS whole, budget % once AS part FROM rows_ AS r JOIN b3 USING (domain, lang, source) WHERE n_tokens > 0 AND budget > 0),
    run AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('7:' || CAST(whole AS VARCHAR) || ':' || own), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM placed),
    copies AS (SELECT *, unnest(range(0, CAST(whole AS INT))) AS epoch FROM placed UNION ALL SELECT * EXCLUDE (begun), CAST(whole AS INT) AS epoch FROM run WHERE begun < part)
    SELECT doc_id, domain, lang, source, CAST(epoch AS INT) AS epoch, n_tokens, CAST(budget AS BIGINT) AS budget FROM copies"""

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(text: str = "text") -> str:
    """The hash of a row's fields, each as `-` or its UTF-8 length, a colon and the value."""
    one = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    return "sha256(" + " || ".join(one(text if c == "text" else c) for c in FIELDS) + ")"


# crc32 of an ASCII string, bit by bit; 3988292384 is its reversed polynomial.
CRC_STEP = "CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END"
CRC32 = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda state, byte: list_reduce(list_prepend(xor(state, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda r, bit: {CRC_STEP})), 4294967295::BIGINT)"

MERKLE = f"""
WITH RECURSIVE
leaves AS (SELECT doc_id, source, {leaf()} AS leaf, CASE WHEN {CRC32} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS other FROM documents),
ordered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, other) - 1 AS place, count(*) OVER (PARTITION BY source) AS size, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS src FROM leaves),
low(src, level, place, size, digest) AS (
    SELECT src, 0, place, size, leaf FROM ordered
    UNION ALL SELECT src, level + 1, place // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM low WHERE size > 1 GROUP BY src, level, place // 3, size),
subroots AS (SELECT src, digest AS subroot, level AS height FROM low WHERE size = 1),
high(level, place, size, digest) AS (
    SELECT 0, src, (SELECT count(*) FROM subroots), subroot FROM subroots
    UNION ALL SELECT level + 1, place // 3, (size + 2) // 3, sha256(string_agg(digest, '' ORDER BY place)) FROM high WHERE size > 1 GROUP BY level, place // 3, size),
nodes AS (SELECT src, level, place, digest FROM low WHERE size > 1 UNION ALL SELECT s.src, s.height + h.level, h.place, h.digest FROM subroots AS s CROSS JOIN high AS h WHERE h.size > 1),
start AS (SELECT row_number() OVER () AS k, a.*, s.height FROM ordered AS a JOIN subroots AS s USING (src)),
path(k, src, level, place, height, digest) AS (
    SELECT k, src, 0, CASE WHEN height = 0 THEN src ELSE place END, height, coalesce(other, leaf) FROM start
    UNION ALL SELECT p.k, p.src, p.level + 1, CASE WHEN p.level + 1 = p.height THEN p.src ELSE p.place // 3 END, p.height, sha256(string_agg(CASE WHEN n.place = p.place THEN p.digest ELSE n.digest END, '' ORDER BY n.place))
    FROM path AS p JOIN nodes AS n ON n.src = p.src AND n.level = p.level AND n.place // 3 = p.place // 3 GROUP BY p.k, p.src, p.level, p.place, p.height),
siblings AS (SELECT p.k, string_agg(n.digest, '' ORDER BY n.level, n.place) AS others FROM path AS p JOIN nodes AS n ON n.src = p.src AND n.level = p.level AND n.place // 3 = p.place // 3 AND n.place <> p.place GROUP BY p.k),
whole AS (SELECT digest AS root FROM high WHERE size = 1),
last AS (SELECT k, digest FROM path QUALIFY row_number() OVER (PARTITION BY k ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(others, '')) AS proof_sha256, last.digest AS folded_root, last.digest = root AS verified
FROM start CROSS JOIN whole JOIN subroots USING (src) JOIN last USING (k) LEFT JOIN siblings USING (k)"""

TERM_BREAK = r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


def term_list(text: str) -> str:
    return f"list_filter(string_split_regex(translate(coalesce({text}, ''), {LETTERS}), {TERM_BREAK}), lambda x: x <> '')"


RANK = f"""
WITH asked AS (SELECT DISTINCT item_id, unnest({term_list('text')}) AS term FROM benchmark),
docs AS (SELECT row_number() OVER () AS k, doc_id, {term_list('text')} AS w FROM documents),
totals AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_words FROM docs WHERE len(w) > 0),
held AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY k, term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM held CROSS JOIN totals GROUP BY term, n_docs),
lengths AS (SELECT k, doc_id, 50 + (50 * CAST(len(w) AS BIGINT) * n_docs) // n_words AS m FROM docs CROSS JOIN totals WHERE doc_id IS NOT NULL),
parts AS (SELECT item_id, k, doc_id, weights.w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS part FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (k)),
scores AS (SELECT item_id, k, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY item_id, k, doc_id HAVING sum(part) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scores
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50"""
