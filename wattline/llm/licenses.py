"""License scan by MinHash bands over overlapping text windows, in DataFrame functions only.

A text is the sequence of its runs of ``[a-z0-9]`` after lower-casing. Its shingles are runs of five
words; templates of fewer words are one shingle of their own length. Templates of about equal length
share windows of twice that length, which overlap by half, so that every stretch as long as a template
lies whole in one window.

A window retrieves a template if they agree in one of many MinHash values (bands of one row). At the
containment asked for, the Jaccard similarity of window and template is at least about 0.19; the number
of bands is chosen so that a window then misses a template with a probability below MISS. Containment
is then exact: the share of the template's shingles that are in the window. Versions of a license differ
in few words, so one of the shingles that hold all of a template's words with a digit must be there too,
if the template has such shingles.

A window can only agree with a template if it holds the template's least shingle under some band's
hash. Texts and windows that hold none of these few shingles are passed over before any value is
computed; that loses no agreement.

Templates are a bounded list (MOST_TEMPLATES) and come to the driver as hashes. Null and empty texts,
and texts without a run of letters or digits, match nothing. Repeated rows are scanned each. An empty
table gives an empty result. Other columns are ignored. Equal containment goes to the first window.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.tables import picked, stored

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4
MOST_TEMPLATES = 2000
_DIGIT = re.compile("[0-9]")

# Public license notices and grants by their common short names.
TEMPLATES = {
    "agpl-3.0": "GNU Affero General Public License",
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version",
    "all-rights-reserved": "All rights reserved",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met",
    "bsd-3-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "bsl-1.0": "Distributed under the Boost Software License, Version 1.0",
    "cc-by-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-nc-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-sa-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
    "this work",
    "epl-1.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License v1.0 which accompanies this distribution",
    "epl-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2",
    "gpl-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
    "option) any later version",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "lgpl-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
    "your option) any later version",
    "lgpl-3.0-notice": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files, to deal in the Software without restriction",
    "mit-licensed": "Licensed under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
    "above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def bands_for(least: float, miss: float = MISS) -> int:
    """Bands of one row that agree at this similarity, but for a probability of ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - least))


def _words(text: str) -> str:
    return f"filter(split(lower({text}), '[^a-z0-9]+'), w -> w != '')"


def _shingles(words: str, size: int) -> str:
    """Hashes of the runs of ``size`` words, as SQL text over a column of word hashes."""
    inside = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return f"IF(size({words}) < {size}, CAST(array() AS array<bigint>), transform(sequence(0, size({words}) - {size}), i -> xxhash64({inside})))"


def _numbers(values) -> str:
    values = list(values)
    if not values:
        return "CAST(array() AS array<bigint>)"
    return "array(" + ", ".join(f"{v}L" if v > -(1 << 63) else "bigint('-9223372036854775808')" for v in values) + ")"


def template_hashes(spark: SparkSession, templates: Mapping[str, str]) -> dict[str, tuple[int, list[int]]]:
    """Shingle size and distinct shingle hashes of every template that has a word."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    found = {}
    names = list(templates)
    for low in range(0, len(names), 50):
        some = names[low : low + 50]
        exprs = ", ".join(f"transform({_words(_text(templates[n]))}, w -> xxhash64(w)) AS c{i}" for i, n in enumerate(some))
        row = spark.sql(f"SELECT {exprs}")
        sizes = row.first()
        cut = [
            f"array_distinct({_shingles(f'c{i}', min(SHINGLE, len(sizes[i])))}) AS c{i}" if sizes[i] else f"CAST(array() AS array<bigint>) AS c{i}"
            for i in range(len(some))
        ]
        hashes = row.selectExpr(*cut).first()
        found |= {n: (min(SHINGLE, len(sizes[i])), list(hashes[i])) for i, n in enumerate(some) if sizes[i]}
    return found


def version_marks(spark: SparkSession, templates: Mapping[str, str]) -> dict[str, list[int]]:
    """Hashes of the shingles that hold all of a template's words with a digit, if it has such words and shingles."""
    marks = {}
    names = list(templates)
    for low in range(0, len(names), 50):
        some = names[low : low + 50]
        words = spark.sql("SELECT " + ", ".join(f"{_words(_text(templates[n]))} AS c{i}" for i, n in enumerate(some)))
        hashed = words.selectExpr(*(f"transform(c{i}, w -> xxhash64(w)) AS c{i}" for i in range(len(some))))
        listed = words.first()
        cut = [_shingles(f"c{i}", min(SHINGLE, len(w))) if w else "CAST(array() AS array<bigint>)" for i, w in enumerate(listed)]
        hashes = hashed.selectExpr(*(f"{c} AS c{i}" for i, c in enumerate(cut))).first()
        for name, own, found in zip(some, listed, hashes):
            version = {w for w in own if _DIGIT.search(w)}
            holds = [version <= set(own[p : p + SHINGLE]) for p in range(len(found))]
            marks[name] = sorted({h for h, fit in zip(found, holds) if fit}) if version else []
    return marks


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def width_class(shingles: int) -> int:
    """Shingles of the longest template that shares the windows: a power of two."""
    return 1 << (shingles - 1).bit_length()


def window_classes(hashed: Mapping[str, tuple[int, list[int]]]) -> dict[tuple[int, int], dict[str, list[int]]]:
    """Templates by shingle size and width."""
    found: dict[tuple[int, int], dict[str, list[int]]] = defaultdict(dict)
    for name, (size, shingles) in hashed.items():
        found[size, width_class(len(shingles))][name] = shingles
    return found


def _least_jaccard(width: int, containment: float) -> float:
    """Of a window with ``2 * width`` shingles and the shortest template of its class."""
    shortest = width // 2 + 1 if width > 1 else 1
    shared = math.ceil(containment * shortest)
    return shared / (2 * width + shortest - shared)


def _minhash(
    spark: SparkSession, templates: Mapping[str, list[int]], bands: int, marks: Mapping[str, list[int]]
) -> DataFrame:
    """``band, value, least, license, wanted, marks``: value and shingle of the minimum of each band."""
    rows = ", ".join(f"({_text(n)}, {_numbers(h)}, {_numbers(marks[n])})" for n, h in templates.items())
    base = spark.sql(f"SELECT * FROM VALUES {rows} AS t(license, wanted, marks)")
    least = "array_min(transform(wanted, h -> named_struct('value', xxhash64(h, band), 'shingle', h)))"
    return base.selectExpr("license", "wanted", "marks", f"explode(sequence(1, {bands})) AS band").selectExpr(
        "band", f"{least}.value AS value", f"{least}.shingle AS least", "license", "wanted", "marks"
    )


def _scan_class(
    near: DataFrame, size: int, width: int, minima: DataFrame, bands: int, known: str, containment: float
) -> DataFrame:
    shingled = near.selectExpr("row", "id", f"{_shingles('words', size)} AS shingles")
    # Windows begin at the multiples of the width. They are cut and picked before they become rows, as
    # each row would carry the whole list along.
    cut = f"named_struct('begin', p, 'win', slice(shingles, p + 1, {2 * width}))"
    windows = f"transform(sequence(0, greatest(size(shingles) - 1, 0), {width}), p -> {cut})"
    valued = shingled.selectExpr(
        "row", "id", f"explode(filter({windows}, x -> arrays_overlap(x.win, {known}))) AS w"
    ).selectExpr(
        "row", "id", "w.begin", "w.win",
        f"explode(transform(sequence(1, {bands}), b -> named_struct('band', b, 'value', array_min(transform(w.win, h -> xxhash64(h, b)))))) AS m",
    )
    # A template list of bounded size: at most MOST_TEMPLATES rows a band.
    met = valued.selectExpr("row", "id", "begin", "win", "m.band", "m.value").join(
        F.broadcast(minima.drop("least")), ["band", "value"]
    )
    retrieved = met.groupBy("row", "begin", "license").agg(
        F.first("id").alias("id"), F.first("win").alias("win"), F.first("wanted").alias("wanted"),
        F.first("marks").alias("marks"),
    )
    return retrieved.where("size(marks) = 0 OR arrays_overlap(marks, win)").selectExpr(
        "row", "id", "license",
        "size(array_intersect(wanted, win)) / size(wanted) AS containment",
        "begin + array_position(transform(win, h -> array_contains(wanted, h)), true) - 1 AS first_word",
    ).where(F.col("containment") >= containment - 1e-9)


def find_licenses(
    docs: DataFrame, templates: Mapping[str, str] | None = None, containment: float = CONTAINMENT,
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``id, license, containment, first_word, n_windows`` for every row and template that match.

    ``first_word`` counts the words of the text from 0; ``n_windows`` overlapping windows matched.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    classes, marks = window_classes(template_hashes(spark, templates)), version_marks(spark, templates)
    plans, least = {}, defaultdict(set)
    for (size, width), own in classes.items():
        bands = bands_for(_least_jaccard(width, containment))
        minima = _minhash(spark, own, bands, marks)
        known = {r["least"] for r in minima.select("least").distinct().collect()}
        plans[size, width] = minima, bands, _numbers(sorted(known))
        least[size] |= known
    rows = picked(docs, id=id, text=text).withColumn("row", F.monotonically_increasing_id())
    if not plans:
        return rows.selectExpr("id", "'' AS license", "0D AS containment", "0L AS first_word", "0L AS n_windows").where("false")
    hashed = rows.selectExpr("row", "id", f"transform({_words('text')}, w -> xxhash64(w)) AS words")
    shingled = hashed.selectExpr("*", *(f"{_shingles('words', size)} AS s{size}" for size in least))
    holds = " OR ".join(f"arrays_overlap(s{size}, {_numbers(sorted(known))})" for size, known in least.items())
    # Not a filter: it would be moved below, with the shingles computed anew for each of their words.
    kept = f"explode(IF({holds}, array(words), CAST(array() AS array<array<bigint>>))) AS words"
    near = stored(shingled.selectExpr("row", "id", kept), "license-texts")
    found = None
    for (size, width), (minima, bands, known) in plans.items():
        more = _scan_class(near, size, width, minima, bands, known, containment)
        found = more if found is None else found.unionByName(more)
    return found.groupBy("row", "license").agg(
        F.first("id").alias("id"),
        F.max("containment").alias("containment"),
        F.min_by("first_word", F.struct(-F.col("containment"), "first_word")).alias("first_word"),
        F.count(F.lit(1)).alias("n_windows"),
    ).select("id", "license", "containment", F.col("first_word").cast("long").alias("first_word"), "n_windows")


def _oracle() -> str:
    """The same windows and containments, with every window compared."""
    words = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda w: w != '')"
    listed = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES.items())
    return f"""WITH t0 AS MATERIALIZED (SELECT license, {words.format('body')} AS w FROM (VALUES {listed}) v(license, body)),
t1 AS MATERIALIZED (SELECT license, w, least({SHINGLE}, len(w)) AS size, list_filter(w, lambda x: regexp_matches(x, '[0-9]')) AS version FROM t0),
t2 AS MATERIALIZED (SELECT DISTINCT license, size, list_slice(w, i + 1, i + size) AS shingle,
    len(version) > 0 AND list_has_all(list_slice(w, i + 1, i + size), version) AS mark
  FROM (SELECT *, unnest(range(0, len(w) - size + 1)) AS i FROM t1)),
t3 AS MATERIALIZED (SELECT license, size, bool_or(mark) AS marked, count(*) AS n, CAST(power(2, ceil(log2(count(*)))) AS BIGINT) AS width FROM t2 GROUP BY ALL),
d0 AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {words.format('text')} AS w FROM documents WHERE text IS NOT NULL),
d1 AS MATERIALIZED (SELECT row, doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS i
  FROM d0, (SELECT DISTINCT size FROM t1)),
met AS (SELECT row, doc_id, t2.license, i, n, width, t2.shingle, mark, marked
  FROM d1 JOIN t2 ON t2.size = d1.size AND t2.shingle = list_slice(w, i + 1, i + d1.size) JOIN t3 ON t3.license = t2.license),
placed AS (SELECT *, i // width * width AS begin FROM met
  UNION ALL SELECT *, (i // width - 1) * width FROM met WHERE i >= width),
windows AS (SELECT row, doc_id, license, begin, count(DISTINCT shingle) / any_value(n) AS containment, min(i) AS first_word
  FROM placed GROUP BY ALL HAVING count(DISTINCT shingle) / any_value(n) >= {CONTAINMENT} - 1e-9
    AND (NOT bool_or(marked) OR bool_or(mark)))
SELECT doc_id, license, max(containment) AS containment, arg_min(first_word, (-containment, first_word)) AS first_word,
  count(*) AS n_windows FROM windows GROUP BY row, doc_id, license"""


ORACLE_SQL = _oracle()
