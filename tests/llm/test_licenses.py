import re

import duckdb
from pyspark.sql import functions as F

from rowtide.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
 in the documentation and/or other materials provided with the distribution.
"""
ENDORSE = """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
 derived from this software without specific prior written permission.
"""
AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#     http://www.apache.org/licenses/LICENSE-2.0
"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
"""
CASES = [
    (MIT, "MIT"), (BSD + AS_IS, "BSD-2-Clause"), (BSD + ENDORSE + AS_IS, "BSD-3-Clause"), (GPL, "GPL-3.0-or-later"),
    ("Words here\nReleased under the MIT License.", "MIT"), ("Words. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("x\nThis work is licensed under the GNU General Public License, version 3.", "GPL-3.0-only"),
    ("This work is licensed under the GPL v2", "GPL-2.0-only"), ("Licensed under CC BY-NC 4.0.\nmore", "CC-BY-NC-4.0"),
    ("Available under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Licence.", "CC-BY-NC-SA-4.0"),
    ("Released under the MIT License. Then. Licensed under CC BY 4.0.", "MIT,CC-BY-4.0"), (MIT + "\n" + GPL, "MIT,GPL-3.0-or-later"),
    ("A licence to print money. All rights reserved.", ""), ("mit license", ""), ("", ""), (None, ""), ("😀 " * 100_000, ""),
    ("the MIT License was not released under the Apache tree.", ""),
]


def test_texts(spark):
    rows = [(i, t, "z") for i, (t, _) in enumerate(CASES)] * 2 + [(None, MIT, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, names string")
    got = licenses.scan(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.licenses == ("MIT" if r.doc_id is None else CASES[r.doc_id][1]), CASES[r.doc_id or 0][0]
    assert licenses.scan(df.limit(0)).count() == 0


def test_apache_header_is_one_licence(spark):
    df = spark.createDataFrame([(1, APACHE)], "doc_id long, text string")
    assert licenses.scan(df).first().licenses == "Apache-2.0"


def test_every_sentence_is_normal_hinted_and_in_a_rule(spark):
    df = spark.createDataFrame([(n, s) for n, s in licenses.SENTENCES.items()], "name string, s string")
    for r in df.select("name", "s", licenses.normalised(F.col("s")).alias("n"), F.col("s").rlike(licenses.HINT).alias("h")).collect():
        assert r.s == r.n and r.h, r.name
    used = {n for _, run in licenses.RULES for n in run}
    assert used <= set(licenses.SENTENCES)
    # a rule is never behind one that is a part of it
    runs = ["".join(f"[{n}]" for n in run) for _, run in licenses.RULES]
    assert all(a not in b for i, a in enumerate(runs) for b in runs[i + 1 :])


# Forms before normalisation, among them such as a filter for words of the normal form would miss.
FORMS = [
    ("Released under the GPL v3.", "GPL-3.0-only"), ("Distributed under the terms of the GNU GPL version 2", "GPL-2.0-only"),
    ("Released under a CC BY 4.0.", "CC-BY-4.0"), ("Made available under\nCC BY 4.0.", "CC-BY-4.0"),
    ("Published under a Creative Commons Attribution 4.0 International.", "CC-BY-4.0"), ("# under\n# the GPL 2.0", "GPL-2.0-only"),
    ("Provided under the\n * CC0 1.0.", "CC0-1.0"), ("Available under an MIT\n  licence.", "MIT"), ("Under a GPLv3", ""),
    ("This is free and unencumbered software released into the public\ndomain.", "Unlicense"), ("\u212a. Under the GPL 3", "GPL-3.0-only"),
]


def test_the_hint_takes_forms_before_normalisation(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(FORMS)], "doc_id long, text string")
    for got, by in ((licenses.scan(df), "hint"), (licenses.scan(df, hint=""), "no hint")):
        assert {r.doc_id: r.licenses for r in got.collect()} == {i: name for i, (_, name) in enumerate(FORMS)}, by
    both = spark.createDataFrame([(1, "All\nrights\n reserved.")], "doc_id long, text string")
    assert licenses.scan(both).first().sentence_ids == "rights-reserved"
    own = licenses.scan(df, known={"x": "under cc by 4.0", "y": "under v"}, rules=())
    assert own.where("n_sentences = 1").count() == 3


def test_the_hint_loses_no_sentence(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert sorted(map(tuple, licenses.scan(docs).collect())) == sorted(map(tuple, licenses.scan(docs, hint="").collect()))


def test_plan_is_native_and_has_no_shuffle(spark, sf):
    plan = licenses.op9_licenses(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = sorted(map(tuple, licenses.op9_licenses(spark, sf).collect()))
    assert got == sorted(con.execute(licenses.OP9_SQL).fetchall())
    assert any(r[3] for r in got)


# Notices as they stand in the files of projects, written down here and not made from the operator's lists.
FOUND = [
    ("// SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */", "GPL-2.0-only WITH Linux-syscall-note"),
    ("# SPDX-License-Identifier: Apache-2.0 OR MIT\nimport os", "Apache-2.0,MIT"),
    ("# Copyright 2020 Some One\n# SPDX-License-Identifier: (GPL-2.0+ OR BSD-3-Clause) AND MIT\n", "GPL-2.0-or-later,BSD-3-Clause,MIT"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR EPL-2.0", "GPL-2.0-only WITH Classpath-exception-2.0,EPL-2.0"),
    ("SPDX-Licence-Identifier: LGPL-2.1-or-later", "LGPL-2.1-or-later"), ("SPDX-License-Identifier: NotALicence-7", ""),
    ("-- SPDX-License-Identifier: Zlib OR Nothing-1 OR ISC\n", "Zlib,ISC"),
    ("This code is licensed under the MIT license, see LICENSE.", "MIT"), ("The MIT License (MIT)\n\nCopyright (c) 2015", "MIT"),
    ("The MIT License (MIT)\n\nCopyright (c) 2015 A. Person\n\n" + MIT, "MIT"),
    ("Licensed under the GNU Lesser General Public License v2.1.", "LGPL-2.1-only"),
    ("This library is distributed under the terms of the LGPL version 2.1 or later.", "LGPL-2.1-or-later"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("This program is made available under the Eclipse Public License 2.0", "EPL-2.0"),
    ("Released under the Eclipse Public License v. 1.0", ""), ("License: GPL-3.0-or-later", "GPL-3.0-or-later"),
    ("Licensed under GPL-3.0-or-later", "GPL-3.0-or-later"), ("Released under the GNU GPL v3 or any later version.", "GPL-3.0-or-later"),
    ("This software is released under the GNU General Public License version 2 or (at your option) any later version.", "GPL-2.0-or-later"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0-only"),
    ("                                 Apache License\n                           Version 2.0, January 2004\n"
     "                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS", "Apache-2.0"),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission", "BSL-1.0"), ("Mozilla Public License Version 2.0\n\n1.", "MPL-2.0"),
    ('  "license": "BSD-3-Clause",\n', "BSD-3-Clause"), ("Licensed under the EUPL 1.2", "EUPL-1.2"),
    ("The font is under the SIL Open Font License, Version 1.1.", ""), ("Licensed under the SIL Open Font License, Version 1.1.", "OFL-1.1"),
    ("This project is licensed under the zlib license.", "Zlib"), ("Released under the WTFPL", "WTFPL"), ("Published under the Unlicense.", "Unlicense"),
    ("Provided under the New BSD License.", "BSD-3-Clause"), ("Available under the Artistic License 2.0.", "Artistic-2.0"),
    ("This file is distributed under the University of Illinois/NCSA Open Source License, see LICENSE.TXT", "NCSA"),
    ("Licensed under CC BY-SA 3.0", "CC-BY-SA-3.0"), ("This database is made available under the Open Database License 1.0", "ODbL-1.0"),
    ("Released under the GNU AGPL v3.", "AGPL-3.0-only"), ("Licensed under the Apache Software License 2.0, found in the file LICENSE", "Apache-2.0"),
    ("Licensed under the ISC license; see the accompanying COPYING file for details", "ISC"), ("Licensed under the Microsoft Public License", "MS-PL"),
    ("Licensed under the PostgreSQL License.", "PostgreSQL"), ("Licensed under the PHP License, version 3.01", "PHP-3.01"),
    ("Licensed under CDDL 1.0", "CDDL-1.0"), ("Released under the Common Public License Version 1.0", "CPL-1.0"),
    ("We were under the impression that the license was free, see license.", ""), ("Drive under 2.0 or later", ""), ("see LICENSE", ""),
]


def test_notices_of_many_kinds(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(FOUND)], "doc_id long, text string")
    for hint in (None, ""):
        got = {r.doc_id: r.licenses for r in licenses.scan(df, hint=hint).collect()}
        assert {FOUND[i][0]: x for i, x in got.items()} == dict(FOUND)
    assert len({x for name in licenses.KNOWN.values() if (x := name).startswith(licenses.IS)}) > 80


def test_known_sentences_are_normal_and_equal_in_sql(spark, tmp_path):
    rows = [(i, s) for i, s in enumerate(licenses.KNOWN)]
    rows += [(len(rows) + i, t) for i, (t, _) in enumerate(FOUND + CASES + FORMS)] + [(None, MIT)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    normal = df.limit(len(licenses.KNOWN)).select("text", licenses.normalised(F.col("text")).alias("n"), F.col("text").rlike(licenses.HINT).alias("h"))
    assert all(r.text == r.n and r.h for r in normal.collect())
    df.where("doc_id is not null").write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    got = sorted(map(tuple, licenses.scan(df.where("doc_id is not null")).collect()))
    assert got == sorted(con.execute(licenses.OP9_SQL).fetchall())
