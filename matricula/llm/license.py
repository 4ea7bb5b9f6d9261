"""License scan: ordered signature rules over the words of a text.

Every rule is a regular expression over the text's words (lower-cased, one space between) behind a plain keyword.
A text with none of the keywords is never given to a regular expression.  Overlapping detections are resolved by
priority: one whose words lie within those of a detection of the same or a better priority is suppressed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matricula.llm.text import spans, word_line

BASE, NOTICE, TAG, ADDRESS, NAME, MENTION = range(6)
CONFIDENCE = (0.9, 1.0, 1.0, 0.95, 0.8, 0.3)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str

    @property
    def stem(self) -> str:
        """What the pattern cannot do without: "licen" where it stands outside all groups, else the keyword."""
        bare, before = self.pattern, ""
        while bare != before:
            before, bare = bare, re.sub(r"\((?:\?:|\?!)[^()]*\)\??|\[sc\]", "", bare)
        return "licen" if "licen" in bare else self.keyword


# Phrases whose places are always reported, with their labels.
BASE_RULES = (
    Rule("gpl", BASE, "gnu general public license", "gnu general public license"),
    Rule("apache", BASE, "apache license", "apache license"),
    Rule("cc-by", BASE, "cc by", "cc by"),
    Rule("mit", BASE, "mit license", "mit license"),
)

# identifier; keyword; name as it is written in running text
NAMES = r"""
0BSD; zero clause; zero clause bsd license
AFL-3.0; academic free; academic free license(?: version| v)?(?: 3 0)?
AGPL-3.0; affero; (?:gnu )?affero general public license(?: version| v)?(?: 3(?: 0)?)?
Apache-1.1; apache software; apache software license(?: version)? 1 1
Apache-2.0; apache; apache (?:software )?licen[sc]e(?: version| v)? 2 0
APSL-2.0; apple public; apple public source license(?: version)?(?: 2 0)?
Artistic-1.0; artistic; (?:perl )?artistic license(?! 2)(?: 1 0)?
Artistic-2.0; artistic; artistic license 2 0
BlueOak-1.0.0; blue oak; blue oak model license(?: 1 0 0)?
BSD-2-Clause; licen; (?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd) license
BSD-3-Clause; licen; (?:new bsd|revised bsd|modified bsd|bsd 3 clause|3 clause bsd) license
BSD-4-Clause; licen; (?:original bsd|bsd 4 clause|4 clause bsd) license
BSL-1.0; boost; boost software license(?: version)?(?: 1 0)?
BUSL-1.1; business source; business source license(?: 1 1)?
CAL-1.0; cryptographic autonomy; cryptographic autonomy license
CC0-1.0; cc0; cc0(?: 1 0)?(?: universal)?
CC-BY-4.0; creative commons; creative commons attribution 4 0(?: international)?
CC-BY-NC-4.0; creative commons; creative commons attribution non ?commercial(?: 4 0)?(?: international)?
CC-BY-ND-4.0; creative commons; creative commons attribution no ?deriv(?:ative)?s?(?: 4 0)?
CC-BY-SA-3.0; creative commons; creative commons attribution sharealike 3 0
CC-BY-SA-4.0; creative commons; creative commons attribution share ?alike(?: 4 0)?(?: international)?
CDDL-1.0; development and distribution; common development and distribution license(?: version)?(?: 1 0)?
CECILL-2.1; cecill; cecill(?: free software)? license(?: version)?(?: 2 1)?
CPL-1.0; common public; common public license(?: version)?(?: 1 0)?
ECL-2.0; educational community; educational community license(?: version)?(?: 2 0)?
EFL-2.0; eiffel; eiffel forum license
EPL-1.0; eclipse; eclipse public license(?: version| v)?(?: 1 0)
EPL-2.0; eclipse; eclipse public license(?: version| v)?(?: 2 0)
EUPL-1.2; european union; european union public licen[cs]e(?: version| v)?(?: 1 2)?
FTL; freetype; freetype (?:project )?license
GFDL-1.3; free documentation; gnu free documentation license(?: version)?(?: 1 \d)?
GPL-1.0; general public; gnu general public license(?: version| v) 1(?: 0)?
GPL-2.0; general public; gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) 2(?: 0)?
GPL-3.0; general public; gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v) 3(?: 0)?
ICU; icu; icu license
IJG; jpeg; independent jpeg group license
IPL-1.0; ibm public; ibm public license(?: version)?(?: 1 0)?
ISC; isc; isc license
LGPL-2.0; library general; gnu library general public license(?: version| v)?(?: 2(?: 0)?)?
LGPL-2.1; lesser general; gnu lesser general public license(?: version| v) 2 1
LGPL-3.0; lesser general; gnu lesser general public license(?: version| v) 3(?: 0)?
libpng-2.0; libpng; (?:png reference library|libpng) license
LPPL-1.3c; latex; latex project public license(?: version)?(?: 1 3c?)?
MIT; mit; (?:the )?mit licen[sc]e(?: mit)?
MIT-0; mit no attribution; mit no attribution(?: license)?
MPL-1.1; mozilla; mozilla public license(?: version| v)? 1 1
MPL-2.0; mozilla; mozilla public license(?: version| v)? 2 0
MS-PL; microsoft public; microsoft public license
MS-RL; microsoft reciprocal; microsoft reciprocal license
MulanPSL-2.0; mulan; mulan permissive software license(?: v| version)?(?: ?2)?
NCSA; ncsa; (?:university of illinois )?ncsa open source license
ODbL-1.0; open database; open database license
ODC-By-1.0; open data commons; open data commons attribution license
OFL-1.1; open font; (?:sil )?open font license(?: version)?(?: 1 1)?
OpenSSL; openssl; openssl license
OSL-3.0; open software; open software license(?: version| v)?(?: 3 0)?
PDDL-1.0; public domain dedication; (?:open data commons )?public domain dedication (?:and|amp) license
PHP-3.01; php; php license(?: version)?(?: 3 01)?
PostgreSQL; postgresql; postgresql license
PSF-2.0; python software; python software foundation license(?: version)?(?: 2)?
QPL-1.0; public license; q public license
Ruby; ruby; ruby license
SSPL-1.0; server side; server side public license(?: version| v)?(?: 1)?
Unicode-DFS-2016; unicode; unicode(?: inc)? license agreement
Unlicense; unlicense; the unlicense
UPL-1.0; universal permissive; universal permissive license(?: version| v)?(?: 1 0)?
Vim; vim; vim license
W3C; w3c; w3c software notice(?: and document notice)? and license
WTFPL; do what the; do what the f\S+ you want to public license
X11; x11; x11 license
Zlib; zlib; zlib(?: libpng)? license
ZPL-2.1; zope; zope public license(?: version)?(?: 2 1)?
"""

# identifier; keyword; address where its text stands, as words
ADDRESSES = r"""
AGPL-3.0; gnu org licenses; gnu org licenses agpl(?: 3 0)?
Apache-2.0; apache org; apache org licenses(?: license 2 0)?
BSL-1.0; boost org; boost org license 1 0 txt
CC-BY-4.0; creativecommons org; creativecommons org licenses by 4 0
CC-BY-NC-4.0; creativecommons org; creativecommons org licenses by nc 4 0
CC-BY-ND-4.0; creativecommons org; creativecommons org licenses by nd 4 0
CC-BY-SA-3.0; creativecommons org; creativecommons org licenses by sa 3 0
CC-BY-SA-4.0; creativecommons org; creativecommons org licenses by sa 4 0
CC0-1.0; creativecommons org; creativecommons org publicdomain zero 1 0
EPL-2.0; eclipse org; eclipse org legal epl 2 0
GFDL-1.3; gnu org licenses; gnu org licenses fdl
GPL-2.0; gnu org licenses; gnu org licenses (?:old licenses )?gpl 2 0
GPL-3.0; gnu org licenses; gnu org licenses gpl(?: 3 0)?(?! 2)
LGPL-2.1; gnu org licenses; gnu org licenses (?:old licenses )?lgpl 2 1
LGPL-3.0; gnu org licenses; gnu org licenses lgpl(?: 3 0)?
MIT; opensource org; opensource org licenses? mit(?: license)?
MPL-2.0; mozilla org; mozilla org (?:en us )?mpl 2 0
OFL-1.1; scripts sil; scripts sil org ofl
Unlicense; unlicense org; unlicense org
WTFPL; wtfpl net; wtfpl net
"""

# identifier; keyword; sentences of its text or of its usual notice
NOTICES = r"""
Apache-2.0; apache license; licensed under the apache license version 2 0 the license you may not use this file except in compliance
Apache-2.0; distributed on an; distributed under the license is distributed on an as is basis without warranties or conditions of any kind
BSD-2-Clause; redistribution and use; redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
BSD-3-Clause; to endorse; neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products
BSD-4-Clause; advertising materials; all advertising materials mentioning features or use of this software must display
BSL-1.0; copyright holders; permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered
CC-BY-4.0; creative commons; licensed under a creative commons attribution 4 0 international license
CC-BY-SA-4.0; creative commons; licensed under a creative commons attribution sharealike 4 0 international license
CC0-1.0; related rights; waived all copyright and related (?:or|and) neighboring rights
GPL-2.0; free software; free software you can redistribute it and or modify it under the terms of the gnu general public license .{0,60}?version 2
GPL-3.0; free software; free software you can redistribute it and or modify it under the terms of the gnu general public license .{0,60}?version 3
LGPL-2.1; free software; free software you can redistribute it and or modify it under the terms of the gnu lesser general public license .{0,60}?version 2
ISC; permission to use; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
MIT; permission is hereby; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
MPL-2.0; source code form; this source code form is subject to the terms of the mozilla public license v 2 0
OFL-1.1; font software; this font software is licensed under the sil open font license
Unlicense; public domain; this is free and unencumbered software released into the public domain
WTFPL; you just do; you just do what the f\S+ you want to
Zlib; provided as is; this software is provided as is without any express or implied warranty in no event will the authors be held liable
"""

# label; keyword; weaker hints, reported where nothing better covers them
MENTIONS = r"""
copyright; copyright; copyright(?: c)? (?:19|20)\d\d
proprietary; rights reserved; all rights reserved
public-domain; public domain; (?:released|placed|dedicated) (?:in|into|to) the public domain
bsd; bsd; bsd(?: style)? licen[sc]e
cc; creative commons; creative commons(?: licen[sc]e)?
gpl; gpl; (?:gnu )?gpl(?: ?v?[123](?: 0)?)?
lgpl; lgpl; (?:gnu )?lgpl(?: ?v?[23](?: [01])?)?
unknown-license; licen; licen[sc]ed under(?: the)?(?: terms of)?(?: the)? \S+ licen[sc]e
"""


def _lines(block: str, priority: int) -> list[Rule]:
    parts = (line.split("; ", 2) for line in block.strip().splitlines())
    return [Rule(label, priority, keyword, pattern) for label, keyword, pattern in parts]


def default_rules() -> list[Rule]:
    """The signatures, best first: base phrases, notices, tags, addresses, names, mentions.

    For every named license two more follow from its line: the tag `SPDX-License-Identifier: <identifier>` and the
    phrase "licensed under <name>"."""
    names = _lines(NAMES, NAME)
    tags = [Rule(r.label, TAG, "spdx license", f"spdx license identifier {' '.join(r.label.lower().replace('.', '-').split('-'))}(?: only| or later)?") for r in names]
    granted = [Rule(r.label, NOTICE, r.keyword, rf"(?:licen[sc]ed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?{r.pattern}") for r in names]
    rules = [*BASE_RULES, *_lines(NOTICES, NOTICE), *granted, *tags, *_lines(ADDRESSES, ADDRESS), *names, *_lines(MENTIONS, MENTION)]
    return sorted(rules, key=lambda r: r.priority)


def _table(rules: list[Rule]) -> Column:
    return F.array(*[F.struct(
        F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(i).alias("rank"),
        F.lit(f" {r.keyword}").alias("keyword"), F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern"),
    ) for i, r in enumerate(rules)])


def _shortest(stems: set[str]) -> list[str]:
    """Stems that contain no other stem, a space before each: a text without these has none of the rules' phrases."""
    return sorted(f" {k}" if k != "licen" else k for k in stems if not any(o != k and o in k for o in stems))


def scan(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, detections and kept.

    detections holds every match as struct<start, end, priority, rank, label> in sorted order, with start and end as
    places in the words joined by single spaces with one space before; kept holds what containment leaves over.  Rows are independent,
    so equal or repeated rows give equal rows, a null id stays null, a null or empty text has no words and no
    detections, and other columns of docs are not touched.  Cost follows the text's length; no row is moved."""
    rules = default_rules() if rules is None else rules
    line = docs.select(F.col(id_col).alias("doc_id"), word_line(F.col(text_col)).alias("line"))
    n_words = F.when(F.col("line") == "", 0).otherwise(F.char_length("line") - F.char_length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    padded = line.select("doc_id", n_words.cast("long").alias("n_words"), F.concat(F.lit(" "), "line", F.lit(" ")).alias("line"))
    gate = None
    for keyword in _shortest({r.stem for r in rules}):
        gate = F.col("line").contains(keyword) if gate is None else gate | F.col("line").contains(keyword)
    kind = "array<struct<start:bigint,end:bigint,priority:int,rank:int,label:string>>"
    table = _table(rules)
    found = F.flatten(F.transform(
        F.filter(table, lambda r: F.col("line").contains(r["keyword"])),
        lambda r: F.transform(spans(F.col("line"), r["pattern"]), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), r["priority"].alias("priority"), r["rank"].alias("rank"), r["label"].alias("label"),
        )),
    ))
    ordered = F.transform(
        F.array_sort(F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), d["priority"].alias("priority"), d["rank"].alias("rank"), d["label"].alias("label")))),
        lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), d["priority"].alias("priority"), d["rank"].alias("rank"), d["label"].alias("label")),
    )
    hit = padded.withColumn("detections", F.when(gate, ordered).otherwise(F.array().cast(kind)) if gate is not None else F.array().cast(kind))
    return hit.withColumn("kept", F.when(F.size("detections") > 0, _uncontained(F.col("detections"))).otherwise(F.array().cast(kind)))


def _uncontained(detections: Column) -> Column:
    """Drops what lies within a detection of the same or a better priority that comes before it in the order
    (start, longest first, priority, rank); all that contain it come before it."""
    levels = len(CONFIDENCE)
    reach = F.array(*[F.lit(-1).cast("long")] * levels)
    kept_type = "array<struct<start:bigint,end:bigint,priority:int,rank:int,label:string>>"

    def step(state: Column, d: Column) -> Column:
        hidden = F.array_max(F.slice(state["reach"], 1, d["priority"] + 1)) >= d["end"]
        further = F.transform(state["reach"], lambda r, p: F.when(p == d["priority"], F.greatest(r, d["end"])).otherwise(r))
        return F.struct(further.alias("reach"), F.when(hidden, state["kept"]).otherwise(F.concat(state["kept"], F.array(d))).alias("kept"))

    start = F.struct(reach.alias("reach"), F.array().cast(kept_type).alias("kept"))
    return F.aggregate(detections, start, step, lambda s: s["kept"])


def license_labels(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of documents: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_kept.

    n_base counts every place of a base phrase; labels joins the base labels and those of the kept detections.
    score is one minus the product of the kept rules' doubts, one doubt per label.  Nulls and repeats as in scan()."""
    found = scan(docs, rules)
    base = F.filter("detections", lambda d: d["priority"] == BASE)
    starts_of = F.transform("base", lambda d: d["start"])
    word_at = lambda place: (F.char_length(F.substring(F.col("line"), F.lit(1), place.cast("int"))) - F.char_length(F.replace(F.substring(F.col("line"), F.lit(1), place.cast("int")), F.lit(" "), F.lit(""))) - 1).cast("long")
    labels = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda d: d["label"])))
    of_priority = lambda priority: labels(F.filter("kept", lambda d: d["priority"] == priority))
    doubt = F.lit(1.0)
    for priority, sure in enumerate(CONFIDENCE):
        doubt = doubt * F.pow(F.lit(1.0 - sure), F.size(of_priority(priority)))
    return found.withColumn("base", base).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.when(F.size("base") > 0, word_at(F.array_min(starts_of))).alias("first_word"),
        F.when(F.size("base") > 0, word_at(F.array_max(starts_of))).alias("last_word"),
        F.array_join(labels(F.col("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels(F.col("base")), labels(F.col("kept")))), ",").alias("labels"),
        F.when(F.size("kept") > 0, 1.0 - doubt).otherwise(0.0).alias("score"),
        F.size("kept").cast("long").alias("n_kept"),
    )
