"""Licence scan by sentence rules, with DataFrame functions only.

A text is cut into sentences; each is normalised (lower case, anything but letters, digits and
``.+-`` to one space, full stops at word ends and hyphens that stand alone gone, so comment marks
do not matter; the stop in "license, v. 2.0" ends no sentence) and mapped to the identifiers of the known
licence sentences it holds, in order.  One search per sentence finds them all: the known sentences
are one pattern that branches word by word, so its cost at a place does not grow with their number.
"Not released under ..." and "no longer licensed under ..." name no licence.  The identifiers of a
document, in order, are then matched against rules: a licence is found where its rule's identifiers
follow each other, unknown sentences between them aside.  Of an SPDX expression the first identifier
is read.

Result per document: ``licenses`` (names joined by ``;``, in the order of the rules),
``sentence_ids`` (joined by ``,``), and ``status``: ``known`` (a rule matched), ``partial`` (known
sentences, but no rule), ``unknown`` (a sentence speaks of a licence in words not known) or
``none``.

Edge cases: null and empty texts are ``none``; nothing is limited by a text's length; repeated rows
give a row each; null ids stay null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised, by identifier.
SENTENCES = {
    1: "released under the mit license",
    2: "licensed under the mit license",
    3: "permission is hereby granted free of charge to any person obtaining a copy of this software",
    4: "the above copyright notice and this permission notice shall be included in all copies or "
       "substantial portions of the software",
    5: "the software is provided as is without warranty of any kind",
    6: "licensed under the apache license version 2.0",
    7: "you may not use this file except in compliance with the license",
    8: "you may obtain a copy of the license at",
    9: "unless required by applicable law or agreed to in writing software distributed under the "
       "license is distributed on an as is basis",
    10: "this work is licensed under the gnu general public license version 3",
    11: "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
    12: "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation either "
        "version 2 of the license or at your option any later version",
    13: "this program is distributed in the hope that it will be useful but without any warranty",
    14: "you should have received a copy of the gnu general public license along with this program",
    15: "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    16: "redistributions of source code must retain the above copyright notice",
    17: "redistributions in binary form must reproduce the above copyright notice",
    18: "neither the name of",
    19: "this software is provided by the copyright holders and contributors as is",
    20: "licensed under cc by-nc 4.0",
    21: "licensed under cc by 4.0",
    22: "licensed under cc by-sa 4.0",
    23: "licensed under cc by-nd 4.0",
    24: "licensed under cc by-nc-sa 4.0",
    25: "this work is licensed under a creative commons attribution 4.0 international license",
    26: "this work is licensed under a creative commons attribution-sharealike 4.0 international "
        "license",
    27: "this work is licensed under a creative commons attribution-noncommercial 4.0 "
        "international license",
    28: "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    29: "the software is provided as is and the author disclaims all warranties",
    30: "this source code form is subject to the terms of the mozilla public license v 2.0",
    31: "this is free and unencumbered software released into the public domain",
    32: "this work is licensed under the gnu general public license version 2",
    33: "this work is licensed under the gnu lesser general public license version 3",
    34: "released under the bsd license",
    35: "the person who associated a work with this deed has dedicated the work to the public domain",
    36: "licensed under the apache license 2.0",
    37: "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu affero general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
    38: "this work is licensed under the gnu affero general public license version 3",
    39: "this library is free software you can redistribute it and or modify it under the terms of "
        "the gnu lesser general public license as published by the free software foundation either "
        "version 2.1 of the license or at your option any later version",
    40: "this library is free software you can redistribute it and or modify it under the terms of "
        "the gnu lesser general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
    41: "this work is licensed under the gnu lesser general public license version 2.1",
    42: "distributed under the boost software license version 1.0",
    43: "permission is hereby granted free of charge to any person or organization obtaining a copy "
        "of the software and accompanying documentation covered by this license",
    44: "this program and the accompanying materials are made available under the terms of the "
        "eclipse public license 2.0",
    45: "this program and the accompanying materials are made available under the terms of the "
        "eclipse public license v2.0",
    46: "this software is provided as-is without any express or implied warranty",
    47: "permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely subject to the following "
        "restrictions",
    48: "the contents of this file are subject to the terms of the common development and "
        "distribution license",
}
# Identifiers after "SPDX-License-Identifier:", by the name they stand for.  Their
# sentences are numbered from 101 on.
SPDX = {
    "MIT": ("MIT",), "Apache-2.0": ("Apache-2.0",), "GPL-3.0": ("GPL-3.0", "GPL-3.0-only"),
    "GPL-3.0-or-later": ("GPL-3.0-or-later", "GPL-3.0+"), "GPL-2.0": ("GPL-2.0", "GPL-2.0-only"),
    "GPL-2.0-or-later": ("GPL-2.0-or-later", "GPL-2.0+"),
    "LGPL-3.0": ("LGPL-3.0", "LGPL-3.0-only"), "LGPL-3.0-or-later": ("LGPL-3.0-or-later",),
    "LGPL-2.1": ("LGPL-2.1", "LGPL-2.1-only"),
    "LGPL-2.1-or-later": ("LGPL-2.1-or-later", "LGPL-2.1+"),
    "AGPL-3.0": ("AGPL-3.0", "AGPL-3.0-only"), "AGPL-3.0-or-later": ("AGPL-3.0-or-later",),
    "BSD-3-Clause": ("BSD-3-Clause",), "BSD-2-Clause": ("BSD-2-Clause",),
    "CC-BY-4.0": ("CC-BY-4.0",), "CC-BY-SA-4.0": ("CC-BY-SA-4.0",),
    "CC-BY-NC-4.0": ("CC-BY-NC-4.0",), "CC-BY-ND-4.0": ("CC-BY-ND-4.0",),
    "CC-BY-NC-SA-4.0": ("CC-BY-NC-SA-4.0",), "CC0-1.0": ("CC0-1.0",), "ISC": ("ISC",),
    "MPL-2.0": ("MPL-2.0",), "Unlicense": ("Unlicense",), "BSL-1.0": ("BSL-1.0",),
    "EPL-2.0": ("EPL-2.0",), "Zlib": ("Zlib",), "CDDL": ("CDDL-1.0", "CDDL-1.1"),
}
_SPDX = [(name, f"spdx-license-identifier {i.lower()}") for name, ids in SPDX.items() for i in ids]
SENTENCES |= {101 + k: s for k, (_, s) in enumerate(_SPDX)}
# Ordered rules, licence name to the identifiers that must follow each other.
RULES = [
    ("MIT", (1,)), ("MIT", (2,)), ("MIT", (3, 4, 5)), ("MIT", (3, 4)),
    ("Apache-2.0", (6,)), ("Apache-2.0", (7, 8, 9)),
    ("GPL-3.0", (10,)), ("GPL-3.0-or-later", (11, 13, 14)), ("GPL-3.0-or-later", (11, 13)),
    ("GPL-2.0", (32,)), ("GPL-2.0-or-later", (12, 13, 14)), ("GPL-2.0-or-later", (12, 13)),
    ("LGPL-3.0", (33,)),
    ("BSD-3-Clause", (15, 16, 17, 18, 19)), ("BSD-2-Clause", (15, 16, 17, 19)), ("BSD", (34,)),
    ("CC-BY-4.0", (21,)), ("CC-BY-4.0", (25,)), ("CC-BY-SA-4.0", (22,)), ("CC-BY-SA-4.0", (26,)),
    ("CC-BY-NC-4.0", (20,)), ("CC-BY-NC-4.0", (27,)), ("CC-BY-ND-4.0", (23,)),
    ("CC-BY-NC-SA-4.0", (24,)), ("CC0-1.0", (35,)),
    ("ISC", (28, 29)), ("MPL-2.0", (30,)), ("Unlicense", (31,)),
    ("Apache-2.0", (36,)), ("AGPL-3.0-or-later", (37,)), ("AGPL-3.0", (38,)),
    ("LGPL-2.1-or-later", (39,)), ("LGPL-3.0-or-later", (40,)), ("LGPL-2.1", (41,)),
    ("BSL-1.0", (42,)), ("BSL-1.0", (43,)), ("EPL-2.0", (44,)), ("EPL-2.0", (45,)),
    ("Zlib", (46, 47)), ("CDDL", (48,)),
] + [(name, (101 + k,)) for k, (name, _) in enumerate(_SPDX)]
#: Every known sentence holds one of these words, so sentences without any are passed over.
KEYWORDS = ("licen", "permission", "permitted", "warrant", "redistribut", "copyright",
            "neither the name", "public domain", "public license")
_HINT = "|".join(KEYWORDS)
#: Between the words of a keyword there may be a line end and a comment mark.
_GAPPED = _HINT.replace(" ", "[^a-z0-9]+")
_CUT = "\u0001"
#: A declaration that is denied, as normalised.
_DENIED = (" (?:not|never|no longer|isn t|aren t|wasn t)(?: be| been| being| currently| yet)?"
           " (?:released|licensed|distributed) under ")


def sentences_of(text: Column) -> Column:
    """The normalised sentences that hold one of the keywords, in order.  Sentences end at . ! ?
    followed by white space, and at blank lines."""
    whole = F.regexp_replace(F.lower(text), r"(license[^a-z0-9]+v)\.[^a-z0-9]+(?=2\.0)", "$1 ")
    cut = F.regexp_replace(whole, r"([.!?])\s+", "$1" + _CUT)
    cut = F.regexp_replace(cut, r"\n[ \t\r]*\n\s*", _CUT)
    hinted = F.filter(F.split(cut, _CUT), lambda s: s.rlike(_GAPPED))
    words = F.transform(hinted, lambda s: F.regexp_replace(s, r"[^a-z0-9.+-]+", " "))
    words = F.transform(words, lambda s: F.regexp_replace(s, r"\.+( |$)", "$1"))
    return F.transform(words, lambda s: F.trim(F.regexp_replace(s, "(^| )-+(?= |$)", "")))


def _branching(sentences: list[list[str]]) -> str:
    """A pattern for any of the sentences (lists of words, none the beginning of another)."""
    by_word: dict[str, list[list[str]]] = {}
    for first, *rest in sentences:
        by_word.setdefault(first, []).append(rest)
    branches = [re.escape(word) + (" " + _branching(rests) if rests[0] else "")
                for word, rests in by_word.items()]
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


#: Any known sentence at a word's beginning; a look ahead, so sentences may overlap.
_KNOWN = f" (?=({_branching([s.split(' ') for s in SENTENCES.values()])}) )"


def ids_of(sentence: Column) -> Column:
    """Identifiers of the known sentences in one normalised sentence, by first place."""
    padded = F.regexp_replace(F.concat(F.lit(" "), sentence, F.lit(" ")), _DENIED, " ")
    found = F.array_distinct(F.regexp_extract_all(padded, F.lit(_KNOWN), F.lit(1)))
    numbers = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, i)])
    return F.transform(found, lambda s: F.element_at(numbers, s))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, licenses, sentence_ids, status."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sentences = F.when(F.lower(text).rlike(_GAPPED), sentences_of(text))
    s = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sentences.alias("_s"))
    s = s.select("doc_id", "_s", F.coalesce(
        F.array_join(F.flatten(F.transform("_s", ids_of)), ","), F.lit("")).alias("sentence_ids"))
    row = F.concat(F.lit(","), F.col("sentence_ids"), F.lit(","))
    names: dict[str, Column] = {}
    for name, ids in RULES:
        hit = F.contains(row, F.lit("," + ",".join(map(str, ids)) + ","))
        names[name] = names[name] | hit if name in names else hit
    s = s.withColumn("licenses", F.concat_ws(";", *[F.when(hit, name)
                                                    for name, hit in names.items()]))
    speaks = F.exists(F.coalesce(F.col("_s"), F.array().cast("array<string>")),
                      lambda x: x.rlike("licen[cs]"))
    return s.select(
        "doc_id", "licenses", "sentence_ids",
        F.when(F.col("licenses") != "", "known").when(F.col("sentence_ids") != "", "partial")
        .when(speaks, "unknown").otherwise("none").alias("status"))


def op8_licenses(docs: DataFrame) -> DataFrame:
    return scan(docs)


def _sql() -> str:
    ids = " || ".join(
        f"(CASE WHEN instr(p, ' {s} ') > 0 THEN [{{'place': instr(p, ' {s} '), 'id': {i}}}] "
        "ELSE [] END)" for i, s in SENTENCES.items())
    names = list(dict.fromkeys(n for n, _ in RULES))
    hits = ", ".join("CASE WHEN " + " OR ".join(
        f"contains(r, ',{','.join(map(str, ids_))},')" for n, ids_ in RULES if n == name)
        + f" THEN '{name}' END" for name in names)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, lower(coalesce(text, '')) AS t
           FROM documents),
c AS (SELECT n, string_split(regexp_replace(regexp_replace(regexp_replace(t,
        '(license[^a-z0-9]+v)\.([^a-z0-9]+2\.0)', '\1 \2', 'g'),
        '([.!?])[\s\x0B]+', '\1' || chr(1), 'g'),
        '\n[ \t\r]*\n[\s\x0B]*', chr(1), 'g'), chr(1)) AS c
      FROM d WHERE regexp_matches(t, '{_GAPPED}')),
s AS (SELECT n, unnest(c) AS s, generate_subscripts(c, 1) AS k FROM c),
w AS (SELECT n, k, array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(
        s, '[^a-z0-9.+-]+', ' ', 'g'), '\.+( |$)', '\1', 'g')), ' '),
        lambda x: NOT regexp_full_match(x, '-+')), ' ') AS w
      FROM s WHERE regexp_matches(s, '{_GAPPED}')),
f AS (SELECT n, k, w, list_sort({ids}) AS f
      FROM (SELECT *, regexp_replace(' ' || w || ' ', '{_DENIED}', ' ', 'g') AS p FROM w)),
g AS (SELECT n, array_to_string(flatten(list(list_transform(f, lambda x: x.id) ORDER BY k)), ',')
        AS sentence_ids, bool_or(regexp_matches(w, 'licen[cs]')) AS speaks FROM f GROUP BY n),
r AS (SELECT doc_id, coalesce(sentence_ids, '') AS sentence_ids,
        ',' || coalesce(sentence_ids, '') || ',' AS r, coalesce(speaks, false) AS speaks
      FROM d LEFT JOIN g USING (n)),
l AS (SELECT *, concat_ws(';', {hits}) AS licenses FROM r)
SELECT doc_id, licenses, sentence_ids, CASE WHEN licenses <> '' THEN 'known'
  WHEN sentence_ids <> '' THEN 'partial' WHEN speaks THEN 'unknown' ELSE 'none' END AS status
FROM l
"""


OP8_SQL = _sql()
