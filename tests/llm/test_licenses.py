"""Licence texts, headers, tags and notices in files, and verdicts that do not depend on the size of the table."""
import re

import pytest
from pyspark.sql import functions as F

from fleetscope.llm import licenses

TEXT = {k: t for k, _, t in licenses.TEXTS}
HEADER = {k: t for k, _, t in licenses.HEADERS}


def scan(spark, rows):
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.how, r.from_directory) for r in licenses.scan(df, F.col("path")).collect()}
    return [got[i] for i in range(len(rows))]


def commented(text, mark):
    words = text.split()
    return "\n".join(f"{mark} " + " ".join(words[i:i + 9]) for i in range(0, len(words), 9))


def test_files_headers_tags_and_inheritance(spark):
    body = "some terms of the agreement that go on and on\n" * 400
    code = "\n\nint main() { return 0; }\n" * 30
    rows = [
        ("a/LICENSE", f"Copyright (c) 2021 Acme\n\n{TEXT['MIT']}"), ("a/src/x.c", code),
        ("b/COPYING.txt", f"                 {TEXT['Apache-2.0']}\n{body}"), ("b/deep/er/y.py", code),
        ("c/apache", f"{TEXT['Apache-2.0']}\n{body}"), ("c/z.py", "x = 1"),
        ("d/e.c", "/*\n" + commented(HEADER["GPL-3.0"], " *") + "\n */" + code), ("d/other.c", code),
        ("d/f.py", "# SPDX-License-Identifier: Apache-2.0\n" + code), ("d/g.rs", "// spdx-license-identifier: GPL-2.0-or-later" + code),
        ("d/h", "# SPDX-License-Identifier: 0BSD" + code), ("e/i.js", commented(HEADER["MPL-2.0"], "//") + code),
        ("f/LICENCE.md", "This file is licensed under the Apache License, Version 2.0 by Acme."), ("f/LICENSES.txt", "nothing here"),
        ("g/k.c", "Copyright 2021 Acme, all rights reserved." + code), ("g/l.c", "Code released under the MIT License." + code),
        ("h/LICENSE", TEXT["BSD-2-Clause"]), ("i/LICENSE", TEXT["BSD-3-Clause"]), ("", "x"), (None, TEXT["MIT"]),
        ("j/LICENSE", None), ("j/x", ""), ("k/l", "a licence to drive under the bridge; the public software of MIT, license plates")]
    got = scan(spark, rows)
    assert got[:6] == [("MIT", "file", None), ("MIT", "inherited", "a"), ("Apache-2.0", "file", None), ("Apache-2.0", "inherited", "b"),
                       ("Apache-2.0", "file", None), ("Apache-2.0", "inherited", "c")]
    assert got[6:12] == [("GPL-3.0", "header", None), (None, "none", None), ("Apache-2.0", "header", None), ("GPL-2.0", "header", None),
                         ("0bsd", "header", None), ("MPL-2.0", "header", None)]
    assert got[12:18] == [("Apache-2.0", "file", None), ("Apache-2.0", "inherited", "f"), ("Proprietary", "header", None),
                          ("MIT", "header", None), ("BSD-2-Clause", "file", None), ("BSD-3-Clause", "file", None)]
    assert got[18:] == [(None, "none", None), ("MIT", "file", None), (None, "none", None), (None, "none", None), (None, "none", None)]


def test_ties_go_by_name_then_path(spark):
    notice = "Released under the ISC License."
    rows = [("r/LICENSE.b", notice), ("r/LICENSE.a", "Released under the MIT License."), ("r/x", "y"),
            ("s/x", f"{notice} Released under the MIT License.")]
    assert scan(spark, rows) == [("ISC", "file", None), ("MIT", "file", None), ("ISC", "inherited", "r"), ("ISC", "file", None)]


@pytest.mark.parametrize("licence, kind", [(k, "text") for k in sorted(TEXT)] + [(k, "header") for k in sorted(HEADER)])
def test_every_text_is_found(spark, licence, kind):
    if not hasattr(test_every_text_is_found, "got"):  # one job for all
        rows = [(f"{k}/x/{n}", f"Acme\n{t}\n") for n, of in (("text", TEXT), ("header", HEADER)) for k, t in of.items()]
        test_every_text_is_found.got = {p: r[0] for (p, _), r in zip(rows, scan(spark, rows))}
    assert test_every_text_is_found.got[f"{licence}/x/{kind}"] == licence


def test_verdicts_do_not_depend_on_the_number_of_rows(spark):
    notices = ["Copyright 2021 Acme, all rights reserved.", "Code released under the MIT License.", "licensed under the MIT license",
               "This file is licensed under the Apache License, Version 2.0", "the rights reserved for others", "see the cc by line"]
    found = []
    for n in (1000, 1_000_000):
        prose = spark.range(n).select((F.col("id") + 100).alias("doc_id"), F.lit("p/x").alias("path"), F.concat(
            F.lit("the plain prose of this under a text "), (F.col("id") % 5000).cast("string")).alias("text"))
        own = spark.createDataFrame([(i, f"{i}/x", t) for i, t in enumerate(notices)], "doc_id long, path string, text string")
        got = licenses.scan(prose.unionByName(own), F.col("path")).filter("doc_id < 100").collect()
        found.append(sorted((r.doc_id, r.licence, round(r.similarity or 0, 2)) for r in got))
    assert [x[:2] for x in found[0]] == [x[:2] for x in found[1]]
    assert all(abs(a[2] - b[2]) < 0.02 for a, b in zip(*found))
    assert [x[1] for x in found[0][:4]] == ["Proprietary", "MIT", "MIT", "Apache-2.0"]


def test_marks_stand_in_their_templates():
    for _, _, mark, before, size, _, words in licenses._numbered():
        assert " ".join(words[before:before + 2]) == mark and len(words) == size
        assert re.search(licenses._MARK, " ".join(words))


def test_notices_without_their_mark_are_found(spark):
    rows = [("a/x", "Subject to the terms of the Mozilla Foundation Public License, version 2.0."),
            ("b/x", "words before it. All rights are reserved. And words behind it that go on and on, more of them than before"),
            ("c/x", HEADER["GPL-2.0"].replace("GNU General", "GNU (General)").replace("General Public", "Gen. Public")),
            ("d/x", TEXT["MIT"].replace("hereby granted", "granted") + " more of it" * 200), ("e/x", "under the terms of the public")]
    prose = [(f"p/{i}", "the plain prose of this under a text that is for you and all to use") for i in range(60)]
    assert [r[0] for r in scan(spark, rows + prose)[:5]] == ["MPL-2.0", "Proprietary", "GPL-2.0", "MIT", None]


def test_only_texts_that_a_template_may_reach_are_kept_and_joined(spark, monkeypatch):
    """Words of the templates stand in most prose; such texts do not go through the joins by row."""
    kept = {}
    real = licenses.written

    def written(df, name):
        kept[name] = real(df, name)
        return kept[name]

    monkeypatch.setattr(licenses, "written", written)
    prose = [(f"p/{i}", f"the public software of the foundation, with a license for {i} of us and no version") for i in range(60)]
    got = scan(spark, [("a/x", "Code released under the MIT License."), ("a/y", "all rights reserved"),
                       ("b/x", "a letter from mit"), ("b/y", "released again"), *prose])
    assert [r[0] for r in got] == ["MIT", "Proprietary"] + [None] * 62
    seen = kept["licence-seen"]
    assert sorted(r["id"] for r in seen.where(F.size("words") > 0).collect()) == [0, 1]
