"""License scan by DataFrame functions: SPDX tags, sparse TF-IDF cosine of headers and licence files to templates, then
inheritance from the nearest directory above that has a licence file.

Templates are short notices, the usual file headers and licence texts (long ones by their opening). Words are compared, not
lines, so that a header over several comment lines reads like one in a line: every window of as many neighbouring words as a
template has, at every position of every text and cut by its ends too, is compared with the template. Only windows that by a
bound on the cosine cannot reach ``least`` are left out before (``_windows``). So a notice is found wherever it stands in a
text of any length, whichever of its words are missing or changed, and what stands beside it does not count. Words weigh by
their share of all documents, counted for every word: idf = 1 - ln(share + RARE), so that words rarer than RARE weigh alike and a notice's weight does not
depend on how large the table is. Equal windows are compared once; term weights, products and lengths are joins and sums
over (window, word) rows. A document's own licence is that of its first SPDX tag, else that of its best window, if the cosine
reaches ``least``.

A licence file is a document with a licence of its own and the name of one (LICENSE, COPYING, ...), or one whose matched window
is at least half of its words, or that begins with a licence text. A directory's licence is that of its best licence file. A
document without a licence of its own takes that of the nearest directory above: every directory that has documents is joined
by the paths of all directories above it to the licensed ones, and the longest path counts. Directories, not documents, go
through that join; the documents join once by directory.

Defined results: a null or empty text and a null path have no licence of their own; a document without a path inherits
nothing; of templates with equal cosines the first by name counts, of licence files with equal cosines the one whose
licence and path sort first; repeated rows and ids are each scanned; extra columns are not read; an empty table gives an
empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import table, written

#: Least cosine of a licence.
LEAST = 0.6
#: Words in a smaller share of the documents weigh alike.
RARE = 0.01
#: Bounds on a cosine are taken so much lower, for what is lost in sums of doubles.
MARGIN = 1e-6
#: A licence text begins within so many words of its file.
HEAD_WORDS = 40

# Usual short notices of public licences.
TEMPLATES = {
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0, Creative Commons Attribution.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0, Creative Commons Attribution ShareAlike.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "EPL-2.0": "Made available under the Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "All rights reserved.",
    "Unlicense": "Released into the public domain under the Unlicense.",
}
# Two neighbouring words of each notice, by which it is found.
MARKS = {
    "AGPL-3.0": "gnu affero", "Apache-2.0": "apache license", "BSD-2-Clause": "bsd 2-clause", "BSD-3-Clause": "bsd 3-clause",
    "CC-BY-4.0": "cc by", "CC-BY-NC-4.0": "cc by-nc", "CC-BY-SA-4.0": "cc by-sa", "CC0-1.0": "cc0 1.0",
    "EPL-2.0": "eclipse public", "GPL-2.0": "gnu general", "GPL-3.0": "gnu general", "ISC": "isc license",
    "LGPL-3.0": "gnu lesser", "MIT": "mit license", "MPL-2.0": "mozilla public", "Proprietary": "rights reserved",
    "Unlicense": "the unlicense",
}
# Usual headers of source files (licence, mark, text).
HEADERS = [
    ("AGPL-3.0", "gnu affero", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "apache license", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", "gnu general", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "gnu general", "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "gnu lesser", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "mozilla public", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
     "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
]
# Licence texts; of the long ones their opening.
TEXTS = [
    ("AGPL-3.0", "19 november", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software "
     "Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("Apache-2.0", "2.0 january", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS "
     "FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("BSD-2-Clause", "binary forms", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
     "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
     "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
     "IMPLIED WARRANTIES"),
    ("BSD-3-Clause", "binary forms", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
     "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
     "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
     "or promote products derived from this software without specific prior written permission."),
    ("EPL-2.0", "eclipse public", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS "
     "ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S "
     "ACCEPTANCE OF THIS AGREEMENT."),
    ("GPL-2.0", "june 1991", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "29 june", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("ISC", "hereby granted", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "29 june", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("MIT", "hereby granted", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this "
     "permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "mozilla public", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or "
     "legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("Unlicense", "unencumbered software", "This is free and unencumbered software released into the public domain. Anyone is free "
     "to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
     "binary, for any purpose, commercial or non-commercial, and by any means."),
]

_WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
_TAG = r"spdx-license-identifier:[ \t]*\(?([a-z0-9.+-]+)"
_FILE = r"(^|/)(licen[cs]e|unlicense|copying|copyright|notice)([._-][^/]*)?$"


def _numbered() -> list[tuple[int, str, str, int, int, bool, list[str]]]:
    """(number, licence, mark, words before the mark, words, a licence text?, the words) of every template."""
    out = []
    for text, rows in ((False, [(k, MARKS[k], t) for k, t in sorted(TEMPLATES.items())] + HEADERS), (True, TEXTS)):
        for licence, mark, t in rows:
            words = re.findall(_WORD, t.lower())
            before = next(i for i in range(len(words)) if " ".join(words[i:i + 2]) == mark)
            out.append((len(out), licence, mark, before, len(words), text, words))
    return out


# Marks and tags of all templates in one pattern; the scan compares texts without a mark too.
_MARK = "|".join(["spdx-license-identifier:"] + [
    "[^a-z0-9]+".join(map(re.escape, m.split())) for m in sorted({t[2] for t in _numbered()})])


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _model(idf: dict[str, float], least: float) -> tuple[list[tuple], set[str]]:
    """Rows (template, size, text, word, share, product, square) of the templates' words by their weights, and the words of which a
    window that reaches ``least`` has at least one. ``share``: the word's part of the squared length; a window's cosine is at
    most the root of the shares of the words that it has. ``product``: what each occurrence adds to the dot product; ``square``:
    at least what it adds to the window's squared length."""
    rows, needed = [], set()
    for n, _, _, _, size, text, words in _numbered():
        weight = {w: c * idf[w] for w, c in Counter(words).items()}
        length = sum(x * x for x in weight.values())
        rest = 1.0
        for w, x in sorted(weight.items(), key=lambda p: (-p[1], p[0])):
            rows.append((n, size, text, w, x * x / length, idf[w] * x / length ** 0.5, idf[w] ** 2))
            if rest >= least * least - MARGIN:
                needed.add(w)
            rest -= x * x / length
    return rows, needed


def _reached(words: Column, rows: list[tuple], needed: set[str], least: float) -> Column:
    """The templates of which ``words`` have so many words that by their shares a window may reach ``least``: no join or shuffle of
    the texts for it, as the words of all templates (``rows`` of ``_model``) are a fixed list."""
    terms: dict[int, list[tuple]] = {}
    for n, _, _, word, share, _, _ in rows:
        terms.setdefault(n, []).append((word, share))
    given = F.array(*(F.struct(F.lit(n).alias("template"), F.array(*(F.struct(F.lit(w).alias("word"), F.lit(x).alias("share"))
                                                                     for w, x in of)).alias("terms")) for n, of in terms.items()))
    low = least - MARGIN
    # as the one element of an array, so that the words of templates are looked up once a text
    own = F.array(F.array_intersect(words, F.array(*map(F.lit, sorted({r[3] for r in rows})))))
    share = lambda t, there: F.aggregate(
        t["terms"], F.lit(0.0), lambda total, x: total + F.when(F.array_contains(there, x["word"]), x["share"]).otherwise(0.0))
    found = F.transform(own, lambda there: F.transform(F.filter(given, lambda t: share(t, there) >= low * low), lambda t: t["template"]))
    some = F.arrays_overlap(words, F.array(*map(F.lit, sorted(needed))))
    return F.when(some, found[0]).otherwise(F.array().cast("array<int>"))


def _windows(seen: DataFrame, counted: DataFrame, model: DataFrame, least: float) -> DataFrame:
    """(row, template, window, whole) of ``seen`` (row, words, templates): for each of its templates all windows of as many words as
    it has, those cut by the ends of the text included, less those that by two bounds cannot reach ``least``: the shares of the
    template's words in the window, and the dot product over the root of the summed squares, at first of the template's words, then
    of all (no more than the length, as a repeated word counts more there). ``whole``: the text is the licence's, as it begins with it or is mostly it."""
    low = least - MARGIN
    hits = seen.select("row", "templates", F.posexplode("words").alias("at", "word")).join(F.broadcast(model), "word").where(
        F.array_contains("templates", F.col("template"))).drop("word", "templates")
    # places in template lengths: a range of 1 holds as many neighbouring places as the template has words
    place = lambda at: F.col(at) / (F.col("size") - 0.5)
    each = Window.partitionBy("row", "template")
    ahead = lambda at: each.orderBy(place(at)).rangeBetween(0, 1)
    hits = hits.withColumns({"shares": F.sum("share").over(ahead("at")), "last": F.lag("at").over(each.orderBy("at"))})
    # every window has one first word of the template's: the windows that begin behind the one before it
    starts = hits.withColumn("start", F.explode(F.sequence(F.greatest(F.coalesce(F.col("last") + 1, F.col("at") - F.col("size") + 1),
                                                                      F.col("at") - F.col("size") + 1), F.col("at"))))
    first = lambda c: F.sum(F.when(F.col("start") == F.col("at"), F.col(c)).otherwise(0.0)).over(ahead("start"))
    starts = starts.withColumns({"dot": first("product"), "own": first("square")}).where(
        (F.col("shares") >= low * low) & (F.col("dot") >= low * F.sqrt("own")))
    starts = written(starts.select(F.col("row").alias("of"), "template", "size", "text", "start", "dot"), "licence-starts")

    # the other words of these texts weigh too
    # words cross the network as one string, not as an array
    texts = seen.select("row", F.array_join("words", " ").alias("line")).join(
        starts.select("of").distinct(), F.col("row") == F.col("of"), "left_semi").select("row", F.split("line", " ").alias("words"))
    squares = texts.select("row", F.posexplode("words").alias("at", "word")).join(counted, "word").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("at", (F.col("idf") * F.col("idf")).alias("square")))).alias("squares"))
    squares = squares.select(F.col("row").alias("squares_of"), F.col("squares.square").alias("squares"))
    cut = starts.join(texts, F.col("of") == F.col("row")).join(squares, F.col("of") == F.col("squares_of")).withColumns({
        "stop": F.least(F.col("start") + F.col("size"), F.size("words")), "start": F.greatest("start", F.lit(0))})
    part = lambda c: F.slice(c, F.col("start") + 1, F.col("stop") - F.col("start"))
    squared = F.aggregate(part("squares"), F.lit(0.0), lambda total, x: total + x)
    return cut.where(F.col("dot") >= low * F.sqrt(squared)).select(
        "row", "template", F.array_join(part("words"), " ").alias("window"),
        ((F.col("text") & (F.col("start") <= HEAD_WORDS)) | (2 * F.col("size") >= F.size("words"))).alias("whole")).distinct()


def own_licences(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` (id, path, text) -> (row, id, path, own struct<similarity, licence>, whole): own is null where there is no tag and
    no window reaches ``least``."""
    spark = docs.sparkSession
    numbered = _numbered()
    n = docs.count()
    weight = lambda df: 1 - F.log(df / F.lit(max(n, 1)) + F.lit(RARE))
    counted = written(docs.select(F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).groupBy("word").agg(
        weight(F.count("*")).alias("idf")), "licence-counted")
    # the words of the templates: bounded by the list above
    own = sorted({w for t in numbered for w in t[6]})
    idf = dict.fromkeys(own, 1 - math.log(RARE)) | {r["word"]: r["idf"] for r in counted.where(F.col("word").isin(own)).collect()}
    rows, needed = _model(idf, least)
    model = spark.createDataFrame(rows, "template int, size int, text boolean, word string, share double, product double, square double")
    # one pass over the texts: tags, and the words of the texts in which a window may reach ``least``, with the templates
    lower = F.lower("text")
    tag = F.when(lower.contains("spdx-license-identifier:"), F.nullif(F.regexp_extract(lower, _TAG, 1), F.lit("")))
    seen = docs.select(F.monotonically_increasing_id().alias("row"), "id", "path", tag.alias("tag"), _words(F.col("text")).alias("words"))
    seen = seen.withColumn("templates", _reached(F.col("words"), rows, needed, least))
    seen = written(seen.select("row", "id", "path", "tag", "templates", F.when(F.size("templates") > 0, F.col("words")).otherwise(
        F.array().cast("array<string>")).alias("words")), "licence-seen")
    windows = written(_windows(seen.where(F.size("words") > 0).select("row", "words", "templates"), counted, model, least),
                      "licence-windows")

    pairs = windows.select("template", "window").distinct()
    terms = written(pairs.select("template", "window", F.explode(F.split("window", " ")).alias("word")).groupBy(
        "template", "window", "word").agg(F.count("*").alias("n")), "licence-terms")
    # a row for each word of the templates: bounded by the list above
    own_words = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(t[0]).alias("template"), F.array(*map(F.lit, t[6])).alias(
        "words")) for t in numbered))).alias("t")).select("t.template", F.explode("t.words").alias("word")).groupBy(
        "template", "word").agg(F.count("*").alias("n"))
    # the documents of every word that stands in a window or a template
    wanted = written(terms.select("word").union(own_words.select("word")).distinct(), "licence-wanted")
    weights = written(wanted.join(counted, "word", "left").select("word", F.coalesce("idf", weight(F.lit(0))).alias("idf")),
                      "licence-words")

    weighted = own_words.join(weights, "word").withColumn("w", F.col("n") * F.col("idf"))
    size = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    templates = F.broadcast(written(weighted.join(F.broadcast(size), "template").select(
        F.col("template").alias("of"), F.col("word").alias("own_word"), (F.col("w") / F.col("size")).alias("t")), "licence-templates"))
    both = terms.join(weights, "word").withColumn("w", F.col("n") * F.col("idf")).join(
        templates, (F.col("template") == F.col("of")) & (F.col("word") == F.col("own_word")), "left")
    cosine = both.groupBy("template", "window").agg(
        F.sum(F.col("w") * F.coalesce("t", F.lit(0.0))).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"))
    name = F.array(*(F.lit(t[1]) for t in numbered))[F.col("template")]
    best = written(cosine.select("template", "window", F.round(F.col("dot") / F.col("size"), 9).alias("cosine"), name.alias(
        "licence")).filter(F.col("cosine") >= least), "licence-best")
    found = windows.join(best, ["template", "window"]).groupBy(
        "row").agg(F.min(F.struct((-F.col("cosine")).alias("neg"), "licence")).alias("best"), F.max("whole").alias("whole"))
    found = written(found.withColumnRenamed("row", "of"), "licence-own")
    known = {x.lower(): x for x in (t[1] for t in numbered)}
    tag = F.col("tag")
    for low, licence in sorted(known.items()):
        tag = F.when(F.regexp_replace("tag", "-(only|or-later)$", "") == low, F.lit(licence)).otherwise(tag)
    of = lambda similarity, licence: F.struct(similarity.alias("similarity"), licence.alias("licence"))
    own = F.when(F.col("tag").isNotNull(), of(F.lit(1.0).cast("double"), tag)).when(
        F.col("best").isNotNull(), of(-F.col("best.neg"), F.col("best.licence")))
    return seen.join(found, F.col("row") == F.col("of"), "left").select(
        "row", "id", "path", own.alias("own"), F.coalesce("whole", F.lit(False)).alias("whole"))


def _directory(path: Column) -> Column:
    """The path without its last part; empty for the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherit(files: DataFrame) -> DataFrame:
    """``files``: id, path, own, is_file (a licence file) -> adds licence, similarity, how and from_directory."""
    files = written(files.withColumn("directory", _directory(F.col("path"))), "licence-files")
    licensed = written(files.filter(F.col("is_file") & F.col("own").isNotNull() & F.col("path").isNotNull()).groupBy(
        "directory").agg(F.min(F.struct((-F.col("own.similarity")).alias("neg"), F.col("own.licence").alias("licence"), F.col(
            "path").alias("file"))).alias("given")).withColumnRenamed("directory", "above"), "licence-directories")
    # every directory with documents, and all directories above it, the top included
    parts = F.split("directory", "/")
    above = F.concat(F.array(F.lit("")), F.transform(parts, lambda p, i: F.array_join(F.slice(parts, 1, i + 1), "/")))
    directories = files.select("directory").filter(F.col("directory").isNotNull()).distinct()
    nearest = directories.select("directory", F.explode(F.array_distinct(above)).alias("above")).join(licensed, "above")
    nearest = written(nearest.groupBy("directory").agg(F.max_by(F.struct("above", "given"), F.length("above")).alias(
        "near")).withColumnRenamed("directory", "of"), "licence-nearest")
    own, near = F.col("own"), F.col("near.given")
    return files.join(nearest, F.col("directory") == F.col("of"), "left").select(
        "id", "path", F.coalesce(own["licence"], near["licence"]).alias("licence"),
        F.coalesce(own["similarity"], -near["neg"]).alias("similarity"),
        F.when(own.isNotNull(), F.when(F.col("is_file"), "file").otherwise("header")).when(near.isNotNull(), "inherited")
        .otherwise("none").alias("how"), F.when(own.isNull(), F.col("near.above")).alias("from_directory"))


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(id, path, licence, similarity, how, from_directory) of every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    named = F.coalesce(F.lower("path").rlike(_FILE), F.lit(False))
    files = own_licences(rows, least).withColumn("is_file", F.col("own").isNotNull() & (F.col("whole") | named))
    return inherit(files.select("id", "path", "own", "is_file")).withColumnRenamed("id", id_col)


def document_path() -> Column:
    """The place of a document in a tree of its source: a directory for each 1000 ids, in it one for each 100; null
    without an id."""
    part = lambda n: F.floor(F.col("doc_id") / n).cast("long").cast("string")
    parts = [F.coalesce(F.col("source"), F.lit("")), part(1000), part(100), F.col("doc_id").cast("string")]
    return F.concat(parts[0], *(x for p in parts[1:] for x in (F.lit("/"), p)))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), document_path())
    return found.select("doc_id", "path", "licence", F.round("similarity", 6).alias("similarity"), "how", "from_directory")


def _rows(rows: list[tuple]) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)


_KNOWN = _rows(sorted({(t[1].lower(), t[1]) for t in _numbered()}))

ORACLE_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS t,
         coalesce(source, '') || '/' || (doc_id // 1000) || '/' || (doc_id // 100) || '/' || doc_id AS path,
         coalesce(source, '') || '/' || (doc_id // 1000) || '/' || (doc_id // 100) AS directory
  FROM documents),
template(n, licence, mark, before, size, is_text, words) AS (VALUES {_rows([(*t[:6], " ".join(t[6])) for t in _numbered()])}),
split AS (SELECT rid, regexp_extract_all(t, '{_WORD}') AS words FROM docs),
big AS (SELECT count(*) AS n FROM docs),
df AS (SELECT word, count(*) AS df FROM (SELECT rid, unnest(list_distinct(words)) AS word FROM split) u GROUP BY word),
pair AS (SELECT rid, words, i, words[i] || ' ' || words[i + 1] AS mark
         FROM (SELECT rid, words, unnest(range(1, len(words))) AS i FROM split) p),
cut AS (
  SELECT DISTINCT rid, n, licence,
         array_to_string(list_slice(pair.words, greatest(i - before, 1), i - before + size - 1), ' ') AS span,
         (is_text AND greatest(i - 1 - before, 0) <= {HEAD_WORDS}) OR 2 * size >= len(pair.words) AS whole
  FROM pair JOIN template USING (mark)),
term AS (SELECT n, span, word, count(*) AS c
         FROM (SELECT n, span, unnest(string_split(span, ' ')) AS word FROM (SELECT DISTINCT n, span FROM cut) d) u GROUP BY ALL),
own_term AS (SELECT n, word, count(*) AS c FROM (SELECT n, unnest(string_split(words, ' ')) AS word FROM template) u GROUP BY ALL),
idf AS (SELECT word, 1 - ln(coalesce(df, 0) / big.n::double + {RARE}) AS idf
        FROM (SELECT word FROM term UNION SELECT word FROM own_term) v LEFT JOIN df USING (word) CROSS JOIN big),
model AS (SELECT n, word, c * idf / sqrt(sum(c * idf * c * idf) OVER (PARTITION BY n)) AS t FROM own_term JOIN idf USING (word)),
cosine AS (
  SELECT term.n, span, round(sum(c * idf * coalesce(t, 0)) / sqrt(sum(c * idf * c * idf)), 9) AS cosine
  FROM term JOIN idf USING (word) LEFT JOIN model ON model.n = term.n AND model.word = term.word GROUP BY term.n, span),
best AS (
  SELECT rid, arg_min(licence, struct_pack(c := -cosine, l := licence)) AS licence, max(cosine) AS similarity, bool_or(whole) AS whole
  FROM cut JOIN cosine USING (n, span) WHERE cosine >= {LEAST} GROUP BY rid),
tagged AS (SELECT rid, nullif(regexp_extract(t, '{_TAG}', 1), '') AS tag FROM docs),
known(low, id) AS (VALUES {_KNOWN}),
files AS (
  SELECT docs.*, CASE WHEN tag IS NOT NULL THEN coalesce(known.id, tag) ELSE licence END AS own,
         CASE WHEN tag IS NOT NULL THEN 1.0 ELSE similarity END AS similarity,
         coalesce(whole, false) AND (tag IS NOT NULL OR licence IS NOT NULL) AS is_file
  FROM docs LEFT JOIN best USING (rid) JOIN tagged USING (rid)
  LEFT JOIN known ON low = regexp_replace(tag, '-(only|or-later)$', '')),
given AS (
  SELECT directory AS above, arg_min(struct_pack(l := own, s := similarity),
         struct_pack(c := -similarity, l := own, p := path)) AS given
  FROM files WHERE is_file GROUP BY directory),
near AS (
  SELECT d.directory, max_by(struct_pack(above := g.above, given := g.given), length(g.above)) AS near
  FROM (SELECT DISTINCT directory FROM files) d JOIN given g ON starts_with(d.directory || '/', g.above || '/')
  GROUP BY d.directory)
SELECT doc_id, path, coalesce(own, near.given.l) AS licence, round(coalesce(similarity, near.given.s), 6) AS similarity,
       CASE WHEN own IS NOT NULL THEN CASE WHEN is_file THEN 'file' ELSE 'header' END
            WHEN near IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
       CASE WHEN own IS NULL THEN near.above END AS from_directory
FROM files LEFT JOIN near USING (directory)
"""
