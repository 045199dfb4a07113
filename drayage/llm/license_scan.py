"""License notices, headers and whole texts in documents, found in overlapping windows by exact shingle containment.

Notices are retrieved by MinHash bands and then verified. Headers and whole texts are retrieved by an index of all their
shingles, which misses nothing; phrases that must or must not be in the window tell apart those that share most words.

A template of L words is looked for in windows of 3/2 L words every L/4 words, so every occurrence lies whole in a window, and
window and template then have a Jaccard similarity of a third or more. With BANDS bands of one MinHash each, such a window
misses its template with probability (2/3) ** BANDS at most: 3e-6 for 32.
"""

from __future__ import annotations

import re
from functools import lru_cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDTH = 5
BANDS = 32

#: fixed values: notices of public licenses
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is free software; you can redistribute it under the GNU General Public License, version 2.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    # this sentence is in BSD-2-Clause and BSD-3-Clause alike, and is reported only where neither is found
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: other usual forms of short notices
NOTICES = [
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Distributed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT License."),
    ("MIT", "Use of this source code is governed by an MIT-style license."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License 2.0."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Released under the ISC License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Use of this source code is governed by a BSD-style license."),
    ("MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    ("GPL-2.0", "Licensed under the GNU General Public License v2.0."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License v3.0."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License v3.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
]

GNU = (
    "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software "
    "Foundation; either version {2} of the License, or (at your option) any later version. This {0} is distributed in the hope that it will be useful, but WITHOUT "
    "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License for more details. "
    "You should have received a copy of the GNU {1}General Public License along with this {0}"
)
APACHE = (
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
ENDORSE = "may be used to endorse or promote products derived from this software without specific prior written permission"
NETWORK = "Remote Network Interaction; Use with the GNU General Public License"
KEEP = "provided that the above copyright notice and this permission notice appear in all copies"
#: whole texts, of the file of that name: (phrases that a window must hold, phrases that it must not hold)
TOLD = {
    "0BSD": ([], [KEEP]),
    "Apache-2.0": ([], []),
    "BSD-2-Clause": ([], [ENDORSE]),
    "BSD-3-Clause": ([ENDORSE], []),
    "CC-BY-SA-4.0": (["Attribution-ShareAlike 4.0 International Public License"], []),
    "CC0-1.0": ([], []),
    "GPL-2.0": ([], []),
    "GPL-3.0": ([], [NETWORK]),
    "ISC": ([KEEP], []),
    "LGPL-2.0": (["GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"], []),
    "LGPL-2.1": (["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"], []),
    "LGPL-3.0": ([], []),
    "MIT": ([], []),
    "MPL-2.0": ([], []),
    "Unlicense": ([], []),
}


@lru_cache
def texts() -> list[tuple[str, str, list[str], list[str]]]:
    """(license, text, phrases it needs, phrases that bar it) of the fixed headers and whole texts."""
    out = [("Apache-2.0", APACHE, [], [])]
    gnu = {"GPL": ("", "program", "23"), "LGPL": ("Lesser ", "library", ["2.1", "3"]), "AGPL": ("Affero ", "program", "3")}
    for name, (kind, what, versions) in gnu.items():
        for v in versions:
            full = v if "." in v else f"{v}.0"
            out.append((f"{name}-{full}", GNU.format(what, kind, v), [f"terms of the GNU {kind}General Public License", f"version {v} of the License"], []))
    folder = files("drayage.llm") / "license_texts"
    held = {n: (folder / f"{n}.txt").read_text() for n in TOLD}
    out += [(n, held[n], *TOLD[n]) for n in TOLD]
    # the AGPL is the GPL with another section 13
    return [*out, ("AGPL-3.0", held["GPL-3.0"], [NETWORK], [])]


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def anchors(templates: list[str], width: int) -> list[str]:
    """Words of which every template shingle holds one, picked greedily, long words first: a text without any holds no shingle."""
    left = [set(w[k : k + width]) for w in map(words_of, templates) for k in range(max(1, len(w) - width + 1))]
    out = []
    while left:
        best = max({x for s in left for x in s}, key=lambda x: (sum(x in s for s in left) * len(x) ** 2, x))
        out.append(best)
        left = [s for s in left if best not in s]
    return out


def sparse_anchors(texts: list[str], width: int, least: float) -> list[str]:
    """Words that more than 1 - `least` of each text's shingles hold: where `least` of them are found, one of these words is."""
    out: list[str] = []
    for w in map(words_of, texts):
        left = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
        most = least * len(left) - 1e-6
        left = {s for s in left if not set(s) & set(out)}
        while len(left) >= most:
            best = max({x for s in left for x in s}, key=lambda x: (sum(x in s for s in left) * len(x) ** 2, x))
            out.append(best)
            left = {s for s in left if best not in s}
    return out


def _any_of(some: list[str]) -> str:
    return r"(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, some)) + r")(?![\p{L}\p{N}])"


def _shingles(words: Column, width: int) -> Column:
    """Distinct 64-bit digests of an array's runs of `width` words."""
    one = lambda i: F.xxhash64(F.array_join(F.slice(words, i + 1, width), " "))
    return F.when(F.size(words) >= width, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(words) - width), one))).otherwise(F.array().cast("array<bigint>"))


def _signature(shingles: Column) -> Column:
    """Each band's number and least hash."""
    def least_of(band: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(F.lit(band), s)))

    least = [least_of(k) for k in range(BANDS)]
    return F.array(*[F.struct(F.lit(k).alias("band"), m.alias("least")) for k, m in enumerate(least)])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, containment, first_word, n_windows): templates of whose shingles a window holds `least` or more.

    first_word is the number, among the document's words, of the first one of a template's shingle in such a window; n_windows
    how many windows hold the template. Without `templates`, the fixed set: TEMPLATES, NOTICES, and the headers and whole texts of texts(); a license has several.
    Words are runs of letters and digits in lower case; templates need `width` words or more. A null or empty text matches
    nothing; rows with one id are reported together, null ids too; extra columns are ignored; an empty table gives no rows.
    """
    notices = list((templates or TEMPLATES).items()) + ([] if templates else NOTICES)
    short = [n for n, t in notices if len(words_of(t)) < width]
    if short:
        raise ValueError(f"templates of fewer than {width} words: {short}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(text_col).alias("text"))
    met = _notices(rows, notices, least, width)
    if not templates:
        met = met.unionByName(_whole(rows, texts(), least, width))
    found = met.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min("word").cast("long").alias("first_word"), F.count_distinct("at").alias("n_windows")
    )
    if templates:
        return found
    told = F.max(F.col("license").isin("BSD-2-Clause", "BSD-3-Clause")).over(Window.partitionBy("doc_id"))
    return found.withColumn("told", told).where("license != 'BSD' OR NOT told").drop("told")


def _words(text: str) -> Column:
    return F.filter(F.split(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def _notices(rows: DataFrame, notices: list[tuple[str, str]], least: float, width: int) -> DataFrame:
    """(doc_id, license, containment, at, word) of the windows that hold a notice, by MinHash bands."""
    spark = rows.sparkSession
    t = spark.createDataFrame([(n, words_of(x), len(words_of(x))) for n, x in notices], "license string, words array<string>, length int")
    t = t.withColumn("have", _shingles(F.col("words"), width))
    bands = t.select("license", "length", "have", F.explode(_signature(F.col("have"))).alias("b")).select("license", "length", "have", "b.*")
    some = anchors([t for _, t in notices], width)
    rows = rows.where(F.col("text").rlike(_any_of(some)))
    words = _words("text")
    wanted = F.array(*map(F.lit, some))

    def windows(ws: Column, length: int) -> Column:
        span = length + length // 2
        starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - 1, F.lit(0)), F.lit(max(1, length // 4)))
        held = F.filter(starts, lambda at: F.arrays_overlap(F.slice(ws, at + 1, span), wanted))
        return F.transform(held, lambda at: F.struct(F.lit(length).alias("length"), at.alias("at"), F.slice(ws, at + 1, span).alias("words")))

    # the words are bound to a variable, and only windows that hold an anchor become rows: no row carries a whole document
    lengths = sorted({len(words_of(x)) for _, x in notices})
    found = F.transform(F.array(words), lambda ws: F.flatten(F.array(*[windows(ws, n) for n in lengths])))[0]
    w = rows.select("doc_id", F.explode(found).alias("w")).select("doc_id", "w.*")
    w = w.select("doc_id", "length", "at", "words", _shingles(F.col("words"), width).alias("has")).where(F.size("has") > 0)
    w = w.select("doc_id", "length", "at", "words", "has", F.explode(_signature(F.col("has"))).alias("b")).select("doc_id", "length", "at", "words", "has", "b.*")
    # templates times BANDS rows, a fixed size
    met = w.join(F.broadcast(bands), ["length", "band", "least"])
    met = met.withColumn("containment", F.size(F.array_intersect("have", "has")) / F.size("have")).where(F.col("containment") >= least)
    known = F.filter(F.sequence(F.lit(0), F.size("words") - width), lambda i: F.array_contains("have", F.xxhash64(F.array_join(F.slice("words", i + 1, width), " "))))
    return met.select("doc_id", "license", "containment", F.col("at").cast("long").alias("at"), (F.col("at") + F.get(known, 0)).cast("long").alias("word"))


def _whole(rows: DataFrame, known: list[tuple[str, str, list[str], list[str]]], least: float, width: int) -> DataFrame:
    """(doc_id, license, containment, at, word) of the windows that hold a header or a whole text, by an index of all shingles."""
    data = []
    for k, (name, text, needs, bars) in enumerate(known):
        for part, t in enumerate([text, *needs, *bars]):
            data.append((k, name, len(words_of(text)), part, len(needs), words_of(t)))
    parts = rows.sparkSession.createDataFrame(data, "whole int, license string, length int, part int, needs int, words array<string>")
    parts = parts.withColumn("have", _shingles(F.col("words"), width)).drop("words")
    index = parts.select("whole", "length", "part", F.explode("have").alias("shingle"))
    sizes = parts.select("whole", "part", "license", "needs", F.size("have").alias("size"))

    rows = rows.where(F.col("text").rlike(_any_of(sparse_anchors([t for _, t, _, _ in known], width, least))))
    one = lambda ws: F.transform(F.sequence(F.lit(0), F.size(ws) - width), lambda i: F.xxhash64(F.array_join(F.slice(ws, i + 1, width), " ")))
    every = F.transform(F.array(_words("text")), lambda ws: F.when(F.size(ws) >= width, one(ws)).otherwise(F.array().cast("array<bigint>")))[0]
    # rows of one id are told apart by their text
    hits = rows.select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(every).alias("pos", "shingle")).join(F.broadcast(index), "shingle")
    step, span = F.greatest(F.lit(1), F.floor(F.col("length") / 4)), F.col("length") + F.floor(F.col("length") / 2)
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") + width - span) / step)).cast("long")
    starts = F.sequence(first, F.floor(F.col("pos") / step).cast("long"))
    held = hits.select("doc_id", "row", "whole", "part", "shingle", "pos", F.explode(F.transform(starts, lambda x: x * step)).alias("at"))
    held = held.groupBy("doc_id", "row", "whole", "part", "at", "shingle").agg(F.min("pos").alias("pos"))
    held = held.groupBy("doc_id", "row", "whole", "part", "at").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"))
    # parts and phrases of the fixed texts, a fixed size
    share = held.join(F.broadcast(sizes), ["whole", "part"]).withColumn("share", F.col("n") / F.col("size"))
    enough = F.col("share") >= least
    body, phrase = F.col("part") == 0, F.col("part") > 0
    share = share.groupBy("doc_id", "row", "whole", "license", "needs", "at").agg(
        F.max(F.when(body, F.col("share"))).alias("containment"),
        F.min(F.when(body, F.col("pos"))).alias("word"),
        F.sum((phrase & (F.col("part") <= F.col("needs")) & enough).cast("int")).alias("given"),
        F.sum((phrase & (F.col("part") > F.col("needs")) & enough).cast("int")).alias("barred"),
    )
    share = share.where((F.col("containment") >= least) & (F.col("given") == F.col("needs")) & (F.col("barred") == 0))
    return share.select("doc_id", "license", "containment", F.col("at").cast("long").alias("at"), F.col("word").cast("long").alias("word"))
