"""Licence scan (8): sentences, ordered rules, edge cases."""

import pytest

from deltaq.llm import licenses

MIT = """Some header
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal.

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
APACHE = """Licensed under the terms below; you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://x. Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS."""


def scan(docs, rows):
    return {r.doc_id: (r.licenses, r.sentence_ids, r.status)
            for r in licenses.op8_licenses(docs(rows, "status")).collect()}


def test_rules_match_sequences_of_sentences(spark, docs):
    got = scan(docs, [
        (1, MIT), (2, APACHE), (3, "x\nReleased under the MIT License."),
        (4, "Text before. This work is licensed under the GNU General Public License, version 3."),
        (5, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."),
        (6, "The above copyright notice and this permission notice shall be included in all copies "
            "or substantial portions of the Software. Then permission is hereby granted, free of "
            "charge, to any person obtaining a copy of this software."),
        (7, "You need a driving licence for this."), (8, "no such words"), (9, None), (10, ""),
        (11, "word " * 200_000 + ". Released under the MIT License."),
    ])
    assert got[1] == ("MIT", "3,4,5", "known")
    assert got[2] == ("Apache-2.0", "7,8,9", "known")
    assert got[3] == ("MIT", "1", "known")
    assert got[4] == ("GPL-3.0", "10", "known")
    assert got[5] == ("Apache-2.0;CC-BY-NC-4.0", "20,6", "known")
    assert got[6] == ("", "4,3", "partial")                # the right sentences in the wrong order
    assert got[7] == ("", "", "unknown")
    for i in (8, 9, 10):
        assert got[i] == ("", "", "none")
    assert got[11] == ("MIT", "1", "known")


def test_repeated_rows_null_ids_and_empty_table(spark, docs):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."),
            (None, "Released under the BSD License.")]
    got = sorted((r.doc_id or 0, r.licenses) for r in licenses.op8_licenses(docs(rows)).collect())
    assert got == [(0, "BSD"), (1, "MIT"), (1, "MIT")]
    assert licenses.op8_licenses(docs([])).collect() == []


@pytest.mark.parametrize("sentence", licenses.SENTENCES.values())
def test_every_known_sentence_is_normal_and_hinted(sentence):
    import re
    assert re.search(licenses._HINT, sentence)
    assert re.fullmatch(r"[a-z0-9.+-]+( [a-z0-9.+-]+)*", sentence)


GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version {} of the
License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES ARE DISCLAIMED."""
LGPL = """This library is free software; you can redistribute it and/or modify it under the terms of
the GNU Lesser General Public License as published by the Free Software Foundation; either version {}
of the License, or (at your option) any later version."""
CC = "This work is licensed under a Creative Commons {} 4.0 International License."
PUBLISHED = {
    "MIT": MIT, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL.format(3),
    "GPL-2.0-or-later": GPL.format(2).replace("software:", "software;"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": BSD.format("3. Neither the name of the copyright holder nor the names of its "
                               "contributors may be used without prior written permission.\n"),
    "BSD-2-Clause": BSD.format(""), "BSD": "Released under the BSD License.",
    "CC-BY-4.0": CC.format("Attribution"), "CC-BY-SA-4.0": CC.format("Attribution-ShareAlike"),
    "CC-BY-NC-4.0": CC.format("Attribution-NonCommercial"),
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.", "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC0-1.0": "The person who associated a work with this deed has dedicated the work to the public\n"
               "domain by waiving all of their rights.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or\n"
           "without fee is hereby granted, provided that the above copyright notice appears.\n\nTHE "
           'SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If "
               "a copy of the MPL was not distributed with this\nfile, You can obtain one at "
               "https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public\ndomain.",
    "AGPL-3.0-or-later": GPL.format(3).replace("GNU General", "GNU Affero General"),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "LGPL-2.1-or-later": LGPL.format("2.1"), "LGPL-3.0-or-later": LGPL.format("3"),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying\nfile "
               "LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "EPL-2.0": "This program and the accompanying materials are made available under the\nterms of "
               "the Eclipse Public License 2.0 which is available at\nhttp://www.eclipse.org/legal",
    "Zlib": "This software is provided 'as-is', without any express or implied\nwarranty. In no event "
            "will the authors be held liable for any damages.\n\nPermission is granted to anyone to "
            "use this software for any purpose,\nincluding commercial applications, and to alter it "
            "and redistribute it\nfreely, subject to the following restrictions:",
    "CDDL": "The contents of this file are subject to the terms of the\nCommon Development and "
            "Distribution License (the \"License\").\nYou may not use this file except in compliance "
            "with the License.",
}


def test_published_text_of_every_rule_is_found_bare_and_in_comments(spark, docs):
    assert set(PUBLISHED) == {name for name, _ in licenses.RULES}
    rows, want = [], {}
    for name, text in PUBLISHED.items():
        for mark in ("", "-- ", "# ", " * "):
            want[len(rows)] = name
            rows.append((len(rows), "\n".join(mark + line for line in text.split("\n"))))
    got = scan(docs, rows)
    assert {i: got[i][0] for i in want} == want
    other = scan(docs, [(1, PUBLISHED["MPL-2.0"].replace("v. 2.0", "v. 1.1"))])
    assert other[1][0] == ""


def by_sql(rows):
    import duckdb
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cursor = db.execute(licenses.OP8_SQL)
    names = [c[0] for c in cursor.description]
    found = (dict(zip(names, r)) for r in cursor.fetchall())
    return {r["doc_id"]: (r["licenses"], r["sentence_ids"], r["status"]) for r in found}


def test_operator_and_sql_agree_on_published_texts(spark, docs):
    rows = [(1000 * k + m, "\n".join(mark + line for line in text.split("\n")))
            for k, text in enumerate(PUBLISHED.values())
            for m, mark in enumerate(("", "-- ", "# ", " * ", "//\u000b"))]
    assert scan(docs, rows) == by_sql(rows)


def test_spdx_lines_shorter_names_and_denials(spark, docs):
    rows = [(1, "// SPDX-License-Identifier: MIT\nint main() {}"), (2, "SPDX-License-Identifier: GPL-2.0+"),
            (3, "Licensed under the Apache License 2.0"),
            (4, "This is not released under the MIT license."),
            (5, "It is no longer licensed under the MIT license. Licensed under CC BY 4.0."),
            (6, "It isn't licensed under the MIT License, but released under the BSD license"),
            (7, "Released under the MIT license, released under the MIT license"),
            (8, "/* SPDX-License-Identifier: MIT OR Apache-2.0 */"),
            (9, "SPDX-License-Identifier: Other-1.0"), (10, "Not all is lost. Released under the MIT license")]
    got = scan(docs, rows)
    assert [got[i][0] for i in range(1, 11)] == [
        "MIT", "GPL-2.0-or-later", "Apache-2.0", "", "CC-BY-4.0", "BSD", "MIT", "MIT", "", "MIT"]
    assert got[4][2] == "unknown" and got[7][1] == "1"
    assert got == by_sql(rows)


def test_no_known_sentence_begins_another():
    every = sorted(s + " " for s in licenses.SENTENCES.values())
    assert not any(b.startswith(a) for a, b in zip(every, every[1:]))
    assert len(set(every)) == len(every)
