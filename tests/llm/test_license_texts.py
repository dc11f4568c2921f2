"""Whole licences, typed here and not taken from the templates, wrapped as published."""

import re
import textwrap

import duckdb
from pyspark.sql import functions as F

from tidewrack.llm import licenses as L

AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
WHOLE = {
    "mit-text": ["MIT License", "Copyright (c) 2021 Ada Example", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", AS_IS],
    "isc-text": ["ISC License", "Copyright 2020 Example and others", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "bsd-2-clause-text": ["Copyright (c) 2019, Example. All rights reserved.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."],
    "unlicense-text": ["This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.", AS_IS.replace(" OR COPYRIGHT HOLDERS", ""), "For more information, please refer to <https://unlicense.org>"],
}


def test_whole_licences_are_found(spark, tmp_path):
    rows = [(i, "\n\n".join(textwrap.fill(p, 78) for p in text)) for i, text in enumerate(WHOLE.values())]
    rows += [(100, "plain words only\nand a second line"), (101, None)]
    long = [n for n in sorted(L.COMPLETE) if n not in WHOLE]
    # The long ones as their files have them, under a title and with words changed here and there.
    for i, name in enumerate(long):
        words = L.COMPLETE[name].split(" ")
        words[::40] = ["changed"] * len(words[::40])
        rows.append((200 + i, "A title\n" + " ".join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = L.op1_license_scan(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.license for r in found if r.line == -1} == dict(enumerate(WHOLE)) | {200 + i: n for i, n in enumerate(long)}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(L.ORACLE).fetchall()) == sorted((r.doc_id, r.line, r.license, r.dice) for r in found)


def test_wrapped_notices_at_the_head_of_a_file(spark):
    code = "\n".join(f"int value_{i} = call_{i}({i});" for i in range(30))
    notices = [n for n, t in L.TEMPLATES.items() if len(L.bigrams_of(t)) > 20]
    rows = [(i, "\n".join(" * " + x for x in textwrap.wrap(L.TEMPLATES[n], 78)) + "\n\n" + code) for i, n in enumerate(notices)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.license for r in L.scan(df).where(F.col("line") == -2).collect()}
    assert len(notices) >= 4 and got == dict(enumerate(notices))


def test_pruning_is_exact_with_long_templates(spark):
    known = L.TEMPLATES | L.COMPLETE
    rows = [(i, "\n\n".join(textwrap.fill(p, 78) for p in text[k:])) for i, text in enumerate(WHOLE.values()) for k in (0, 1, 2)]
    want = []
    for doc, text in rows:
        blocks = re.split(L.PARAGRAPHS, text)
        for n, unit in [*enumerate(text.split("\n")), (-1, text), *((-2 - k, b) for k, b in enumerate(blocks) if len(blocks) > 1 and "\n" in b)]:
            a = {*L.bigrams_of(unit)}
            best = max(((2 * len(a & {*L.bigrams_of(b)}) / (len(a) + len({*L.bigrams_of(b)})), k) for k, b in sorted(known.items()) if a), key=lambda x: x[0], default=(0, ""))
            if best[0] >= 0.8:
                want.append((doc, n, best[1], round(best[0], 9)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.line, r.license, round(r.dice, 9)) for r in L.scan(df, known).collect()) == sorted(want)
