"""Licence recognition by sentences.

Texts are normalised (ASCII letters lower, everything but letters, digits, inner dots and line breaks a space; an end
of sentence is an empty line) and searched for a table of known licence sentences, part of it made by rule from the
licences' names. A sentence begins at a line's start
or after another's end, and stops at an end or a line's; any of its spaces may be a line break (LF, CRLF or CR, with
indents and comment marks before the next line), so that it is found however its lines are wrapped. The first and
longest match goes. The identifiers found, in text order, form a sequence; ordered rules name the licence of a run of
identifiers, longer runs first, and what a rule matched is used up; what is left may state a licence by itself, as
notices and SPDX tags do. All of it happens within a row, in column
expressions: nothing is joined or shuffled.

Defined cases: an empty line ends a sentence; a word divided between two lines is two words; a null or empty
text, and one without known sentences, has an empty sequence and no licence; repeated sentences and licences are
counted each time, and a licence is named once; columns of the input that bear an added column's name are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from .common import without

ADDED = ["sequence", "n_known", "n_unused", "licences"]
#: Normalised sentences of public licence texts and notices, by identifier.
GRANT = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
ENDORSE = "neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
SENTENCES = {
    "apache-2.0-compliance": ["you may not use this file except in compliance with the license"],
    "apache-2.0-asis": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "mit-grant": [f"{GRANT} subject to the following conditions"],
    "mit-0-grant": [GRANT],
    "mit-keep": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "asis-software": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "x11-names": ["except as contained in this notice the name of the x consortium shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from the x consortium"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "0bsd-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "isc-asis": ["the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-advert": ["all advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-endorse": [ENDORSE.format(x) for x in ("the copyright holder", "the university", "the author", "the copyright owner", "the organization", "the company")],
    "bsd-asis": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "zlib-asis": ["this software is provided as is without any express or implied warranty"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "bsl-1.0-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "postgresql-grant": ["permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"],
    "hpnd-grant": ["permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation"],
    "gpl-2.0-only": ["you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"],
    "gpl-hope": [f"this {x} is distributed in the hope that it will be useful but without any warranty" for x in ("program", "library", "software", "file", "package")],
    "mpl-2.0-notice": ["this source code form is subject to the terms of the mozilla public license v"],
    "unlicense-release": ["this is free and unencumbered software released into the public domain"],
    "unlicense-grant": ["anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"],
    "wtfpl-title": ["do what the fuck you want to public license"],
    "classpath-exception": ["as a special exception the copyright holders of this library give you permission to link this library with independent modules to produce an executable regardless of the license terms of these independent modules and to copy and distribute the resulting executable under terms of your choice provided that you also meet for each linked independent module the terms and conditions of the license of that module"],
    "gcc-exception": ["under section 7 of gpl version 3 you are granted additional permissions described in the gcc runtime library exception version 3.1 as published by the free software foundation"],
    "autoconf-exception": ["as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script generated by autoconf you may include it under the same distribution terms that you use for the rest of that program"],
    "bison-exception": ["as a special exception you may create a larger work that contains part or all of the bison parser skeleton and distribute that work under terms of your choice so long as that work isn t itself a parser generator using the skeleton or a modified version thereof as a parser skeleton"],
    "font-exception": ["as a special exception if you create a document which uses this font and embed this font or unaltered portions of this font into the document this font does not by itself cause the resulting document to be covered by the gnu general public license"],
}
#: Names that notices give licences, and the titles above their texts, by the licence's SPDX name.
NAMES = {
    "MIT": ["mit license", "expat license"], "ISC": ["isc license"], "Apache-2.0": ["apache license version 2.0", "apache license version 2.0 the license", "apache license 2.0", "apache 2.0 license"], "Apache-1.1": ["apache software license version 1.1"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"], "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license"], "BSD-4-Clause": ["bsd 4 clause license", "original bsd license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl version 2", "gplv2"], "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl version 3", "gplv3"],
    "LGPL-2.0": ["gnu library general public license version 2"], "LGPL-2.1": ["gnu lesser general public license version 2.1", "gnu lgpl version 2.1"], "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lgpl version 3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu agpl version 3"], "MPL-1.1": ["mozilla public license version 1.1"], "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0"],
    "EPL-1.0": ["eclipse public license 1.0", "eclipse public license version 1.0"], "EPL-2.0": ["eclipse public license 2.0", "eclipse public license version 2.0"], "EUPL-1.2": ["european union public licence version 1.2"],
    "CDDL-1.0": ["common development and distribution license version 1.0"], "BSL-1.0": ["boost software license version 1.0"], "Zlib": ["zlib license"], "Unlicense": ["unlicense"], "WTFPL": ["wtfpl license"], "Artistic-2.0": ["artistic license 2.0"],
    "OFL-1.1": ["sil open font license version 1.1"], "PostgreSQL": ["postgresql license"], "NCSA": ["university of illinois ncsa open source license"], "Python-2.0": ["python software foundation license version 2"], "MS-PL": ["microsoft public license"],
    "UPL-1.0": ["universal permissive license version 1.0"], "ECL-2.0": ["educational community license version 2.0"], "AFL-3.0": ["academic free license version 3.0"], "OSL-3.0": ["open software license version 3.0"],
    "CC0-1.0": ["cc0 1.0 universal", "creative commons cc0 1.0 universal license"],
}
TITLES = {
    "gnu general public license version 2 june 1991": "GPL-2.0", "gnu general public license version 3 29 june 2007": "GPL-3.0", "gnu library general public license version 2 june 1991": "LGPL-2.0",
    "gnu lesser general public license version 2.1 february 1999": "LGPL-2.1", "gnu lesser general public license version 3 29 june 2007": "LGPL-3.0", "gnu affero general public license version 3 19 november 2007": "AGPL-3.0",
    "apache license version 2.0 january 2004": "Apache-2.0", "boost software license version 1.0 august 17th 2003": "BSL-1.0", "sil open font license version 1.1 26 february 2007": "OFL-1.1", "eclipse public license v 2.0": "EPL-2.0",
    "eclipse public license v 1.0": "EPL-1.0", "mozilla public license version 2.0": "MPL-2.0", "mozilla public license version 1.1": "MPL-1.1",
}
#: SPDX names of licences and exceptions that a tag may bear.
TAGS = """0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0
CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-or-later GPL-2.0 GPL-2.0-only
GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IJG IPL-1.0 ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c
MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 Unicode-DFS-2016 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1""".split()
EXCEPTIONS = "Autoconf-exception-3.0 Bison-exception-2.2 Classpath-exception-2.0 Font-exception-2.0 GCC-exception-3.1 Linux-syscall-note LLVM-exception".split()
#: Tags that are often joined by OR or AND, and those that exceptions go with.
JOINED = ["Apache-2.0", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "ISC", "MIT", "Unlicense", "Zlib"]
EXCEPTED = ["Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"]
#: What stands before a name in a notice, and instead of it in the table.
VERBS = "licensed|released|distributed|available|published"
NOTICE, UNDER = rf"(?:this (?:software|project|work|program|library|package|file|document) is )?(?:{VERBS}) under (?:the |a )?", "under: "
TAG = "spdx license identifier"


def plain(name: str) -> str:
    return name.lower().replace("-", " ")


def family() -> dict[str, list[str]]:
    """Later-version notices of the GNU licences, by identifier."""
    kinds = {"gpl-2.0": ("general", "2"), "gpl-3.0": ("general", "3"), "lgpl-2.0": ("library general", "2"), "lgpl-2.1": ("lesser general", "2.1"), "lgpl-3.0": ("lesser general", "3"), "agpl-3.0": ("affero general", "3")}
    return {f"{i}-or-later": [f"you can redistribute it and or modify it under the terms of the gnu {kind} public license as published by the free software foundation either version {v} of the license or at your option any later version"] for i, (kind, v) in kinds.items()}


def table() -> tuple[dict[str, str], dict[str, str]]:
    """Identifier of each known sentence; and the licence that an identifier states by itself."""
    known = {t: i for i, texts in (SENTENCES | family()).items() for t in texts}
    alone = {"mpl-2.0-notice": "MPL-2.0", "gpl-2.0-only": "GPL-2.0-only", "unlicense-release": "Unlicense", "wtfpl-title": "WTFPL", "isc-grant": "ISC", "0bsd-grant": "0BSD", "mit-0-grant": "MIT-0", "bsl-1.0-grant": "BSL-1.0", "postgresql-grant": "PostgreSQL", "hpnd-grant": "HPND", "zlib-grant": "Zlib"}
    alone |= {i: i.upper().replace("-OR-LATER", "-or-later") for i in family()}
    names = {k: list(v) for k, v in NAMES.items()}
    for parts in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd"):
        said = " ".join({"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}[x] for x in parts.split("-"))
        for version, place in (("4.0", "international"), ("3.0", "unported")):
            names[f"CC-{parts.upper()}-{version}"] = [f"cc {plain(parts)} {version}", f"creative commons {said} {version} {place} license"]
    for licence, said in names.items():
        for name in said:
            known[UNDER + name] = f"{licence.lower()}-notice"
        alone[f"{licence.lower()}-notice"] = licence
    for title, licence in TITLES.items():
        known.setdefault(title, f"{licence.lower()}-title")
        alone[f"{licence.lower()}-title"] = licence
    tags = [*TAGS, *(f"{a} {how} {b}" for a in JOINED for b in JOINED for how in ("OR", "AND") if a != b), *(f"{a} WITH {b}" for a in EXCEPTED for b in EXCEPTIONS)]
    for tag in tags:
        known[f"{TAG} {plain(tag)}"] = f"tag-{tag.lower().replace(' ', '_')}"
        alone[f"tag-{tag.lower().replace(' ', '_')}"] = tag
    return known, alone


KNOWN, ALONE = table()
#: Ordered rules: a run of identifiers and the licence that it states. What they leave, each identifier states by itself.
RULES = [
    (["mit-grant", "mit-keep", "asis-software", "x11-names"], "X11"),
    (["mit-grant", "mit-keep", "asis-software"], "MIT"),
    (["mit-grant", "mit-keep"], "MIT"),
    (["mit-0-grant", "asis-software"], "MIT-0"),
    (["isc-grant", "asis-software"], "ISC"),
    (["isc-grant", "isc-asis"], "ISC"),
    (["0bsd-grant", "isc-asis"], "0BSD"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse", "bsd-asis"], "BSD-4-Clause"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse"], "BSD-4-Clause"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-asis"], "BSD-3-Clause"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"], "BSD-3-Clause"),
    (["bsd-grant", "bsd-source", "bsd-binary", "bsd-asis"], "BSD-2-Clause"),
    (["bsd-grant", "bsd-source", "bsd-binary"], "BSD-2-Clause"),
    (["zlib-asis", "zlib-grant"], "Zlib"),
    (["bsl-1.0-grant", "asis-software"], "BSL-1.0"),
    (["unlicense-release", "unlicense-grant", "asis-software"], "Unlicense"),
    (["unlicense-release", "unlicense-grant"], "Unlicense"),
    (["apache-2.0-notice", "apache-2.0-compliance", "apache-2.0-asis"], "Apache-2.0"),
    (["apache-2.0-notice", "apache-2.0-compliance"], "Apache-2.0"),
    (["gpl-3.0-or-later", "gpl-hope", "gcc-exception"], "GPL-3.0-or-later WITH GCC-exception-3.1"),
    (["gpl-3.0-or-later", "gpl-hope", "autoconf-exception"], "GPL-3.0-or-later WITH Autoconf-exception-3.0"),
    (["gpl-3.0-or-later", "gpl-hope", "bison-exception"], "GPL-3.0-or-later WITH Bison-exception-2.2"),
    (["gpl-3.0-or-later", "gpl-hope", "font-exception"], "GPL-3.0-or-later WITH Font-exception-2.0"),
    (["gpl-2.0-or-later", "gpl-hope", "classpath-exception"], "GPL-2.0-or-later WITH Classpath-exception-2.0"),
    *(([i, "gpl-hope"], ALONE[i]) for i in [*family(), "gpl-2.0-only"]),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The SQL joins fewer lines: it gives the same rows where no known sentence is wrapped otherwise.
WRAPPED, ENDS, OTHER = r"([a-z,])\n[ \t*#/-]*([a-z])", r"[.!?;:]+([ \t\r\n]|$)|\n", "[^a-z0-9.]+"


def signs(texts: list[str]) -> list[str]:
    """Words, so chosen that each text holds one: texts without any needn't be searched."""
    left, out = set(texts), []
    while left:
        count = Counter(w for t in left for w in set(t.split()) if len(w) > 5)
        out.append(min(count, key=lambda w: (-count[w], w)))
        left = {t for t in left if out[-1] not in t}
    return out


HINTS = "|".join([*VERBS.split("|"), *signs([t for t in KNOWN if not t.startswith(UNDER)])])
#: Steps before the search, in this order: line breaks, marks of comments before a line, ends of sentences, all else
#: but line breaks, what stands about line breaks. A run of characters is tried at its start only.
STEPS = [(r"\r\n?", "\n"), (r"(^|\n)[ \t;*#/%!>-]+", "$1"), (r"(?<![.!?;:])[.!?;:]++(?:[ \t\n]|$)", "\n\n"), (r"[^a-z0-9.\n]+", " "), (r"(?:\G|(?<![ .]))[ .]*+\n[ .]*+", "\n"), (r"^[ .]+|(?<![ .])[ .]++$", "")]


def branches(words: list[list[str]]) -> str:
    """A pattern for any of several runs of words, with common beginnings written once and longer ones first."""
    heads: dict[str, list[list[str]]] = {}
    for run in words:
        if run:
            heads.setdefault(run[0], []).append(run[1:])
    told = [re.escape(w) + (r"[ \n]" if all(rests) else "") * (len(rests) > 0) + ("" if not any(rests) else branches(rests) if all(rests) else rf"(?:[ \n]{branches([r for r in rests if r])})?") for w, rests in sorted(heads.items())]
    return told[0] if len(told) == 1 else "(?:" + "|".join(told) + ")"


def searched() -> str:
    """The pattern of all known sentences as whole lines or runs of lines; a tag's name may stand after an end."""
    texts = branches([t.split() for t in KNOWN if not t.startswith((TAG, UNDER))])
    names = branches([t.removeprefix(UNDER).split() for t in KNOWN if t.startswith(UNDER)])
    tags = branches([t.removeprefix(TAG).split() for t in KNOWN if t.startswith(TAG)])
    return rf"(?<=\n)(?:{texts}|{NOTICE.replace(' ', '[ \n]')}{names}|{TAG}\n+{tags})(?=\n)"


def known(text: Column) -> Column:
    """The identifiers of the known sentences of text, in order."""
    lower = F.translate(text, UPPER, LOWER)
    normal = lower
    for pattern, instead in STEPS:
        normal = F.regexp_replace(normal, pattern, instead)
    found = F.regexp_extract_all(F.concat(F.lit("\n"), normal, F.lit("\n")), F.lit(searched()), F.lit(0))
    names = F.create_map(*[F.lit(x) for t, i in KNOWN.items() for x in (t, i)])
    named = F.transform(found, lambda s: F.element_at(names, F.regexp_replace(F.regexp_replace(s, r"\n+", " "), f"^{NOTICE}", UNDER)))
    return F.when(lower.rlike(HINTS), named).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with sequence (array of identifiers), n_known, n_unused (identifiers that no rule took) and licences (array, in rule order)."""
    docs = without(docs, ADDED)
    out = docs.withColumn("sequence", known(F.coalesce(F.col(text), F.lit(""))))
    rules = F.array(*[F.struct(F.lit(run_of(ids)).alias("run"), F.lit(licence).alias("licence")) for ids, licence in RULES])
    start = F.struct(F.concat(F.lit("<"), F.array_join("sequence", "><"), F.lit(">")).alias("left"), F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["run"])
        return F.struct(F.when(hit, F.replace(state["left"], rule["run"], F.lit("|"))).otherwise(state["left"]).alias("left"), F.when(hit, F.array_append(state["found"], rule["licence"])).otherwise(state["found"]).alias("found"))

    out = out.withColumn("_state", F.when(F.size("sequence") > 0, F.aggregate(rules, start, apply)).otherwise(F.struct(F.lit("").alias("left"), F.array().cast("array<string>").alias("found"))))
    out = out.withColumn("_left", F.regexp_extract_all("_state.left", F.lit("<([^>]+)>"), F.lit(1)))
    stated = F.create_map(*[F.lit(x) for pair in ALONE.items() for x in pair])
    own = F.filter(F.transform("_left", lambda i: F.element_at(stated, i)), lambda x: x.isNotNull())
    named = F.when(F.size("_left") > 0, own).otherwise(F.array().cast("array<string>"))
    return out.withColumns({"n_known": F.size("sequence").cast("long"), "n_unused": (F.size("_left") - F.size(named)).cast("long"), "licences": F.array_distinct(F.concat("_state.found", named))}).drop("_state", "_left")


def run_of(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def op10_licence_sentences(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", "n_known", "n_unused", F.array_join("sequence", ",").alias("sequence"), F.array_join(F.array_sort("licences"), ",").alias("licences"))


def oracle() -> str:
    rows = ", ".join(f"('{t}', '{i}')" for t, i in KNOWN.items())
    stated = ", ".join(f"('{i}', '{licence}')" for i, licence in ALONE.items())
    steps = "".join(
        f",\ns{k} AS (SELECT doc_id, CASE WHEN contains(l, '{run_of(ids)}') THEN replace(l, '{run_of(ids)}', '|') ELSE l END AS l, CASE WHEN contains(l, '{run_of(ids)}') THEN list_append(f, '{licence}') ELSE f END AS f FROM s{k - 1})"
        for k, (ids, licence) in enumerate(RULES, 1)
    )
    return rf"""
WITH known(s, i) AS (VALUES {rows}),
stated(i, licence) AS (VALUES {stated}),
cuts AS (
  SELECT doc_id, string_split_regex(translate(regexp_replace(coalesce(text, ''), '{WRAPPED}', '\1 \2', 'g'), '{UPPER}', '{LOWER}'), '{ENDS}') AS parts FROM documents),
sent AS (SELECT doc_id, unnest(range(0, len(parts))) AS p, unnest(parts) AS s FROM cuts),
clean AS (SELECT doc_id, p, regexp_replace(regexp_replace(s, '{OTHER}', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g') AS s FROM sent),
tagged AS (SELECT a.doc_id, a.p, '{TAG} ' || b.s AS s FROM clean a JOIN clean b ON a.doc_id = b.doc_id AND b.p = a.p + 1 WHERE a.s = '{TAG}'),
noted AS (SELECT doc_id, p, regexp_replace(s, '^{NOTICE}', '{UNDER}') AS s FROM clean),
hit AS (SELECT doc_id, p, i FROM (FROM noted UNION ALL FROM tagged) JOIN known USING (s)),
seq AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY p) AS q, string_agg('<' || i || '>', '' ORDER BY p) AS l FROM hit GROUP BY doc_id),
s0 AS (SELECT doc_id, l, CAST([] AS VARCHAR[]) AS f FROM seq){steps},
rest AS (SELECT doc_id, unnest(regexp_extract_all(l, '<([^>]+)>', 1)) AS i FROM s{len(RULES)}),
own AS (SELECT doc_id, count(*) - count(licence) AS unused, list(licence) FILTER (WHERE licence IS NOT NULL) AS g FROM rest LEFT JOIN stated USING (i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_known, coalesce(unused, 0)::BIGINT AS n_unused, coalesce(q, '') AS sequence,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(f, coalesce(g, CAST([] AS VARCHAR[]))))), ','), '') AS licences
FROM documents d LEFT JOIN seq USING (doc_id) LEFT JOIN s{len(RULES)} e USING (doc_id) LEFT JOIN own USING (doc_id)
"""


OP10_SQL = oracle()
