"""License scans: MinHash bands over overlapping text windows, verified by exact containment.

Main path: DataFrame operations only.

Templates are put in size classes by their number of shingles, with powers of two as upper bounds u.
For each class a text is cut into windows of ``u + step - 1`` shingles, a quarter of u apart, so a
template that runs on lies whole in some window. A template with at least c of its shingles in
such a window has a Jaccard similarity of at least s with it, where s follows from c, the window's
length and the least size in the class; the class gets as many bands of one minimum as bring the
chance of no collision, (1 - s) ** bands, below ``MISS``.

A band's minimum of a template is one of its shingles, and a window can only collide in that band if it
holds this shingle. So the templates' minimal shingles, a table of at most ``bands`` rows a template, are
looked up among the shingles of all texts first, which loses no collision; bands are then formed only for
the windows about what was found. What collides is verified by the exact share of the template's
shingles in the window. Templates are a table of any size: its minima are broadcast when counted to
be few, else shuffled with the texts' shingles.

Texts are compared in lower case without the characters ``.,;:()"'``.

Defined results: null or empty text matches nothing; a null doc_id is reported with its null;
repeated rows are reported once; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut, fits
from .text import ascii_lower, shingle_hashes, words

#: License statements and texts looked for: fixed values, as their authors publish them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0-notice", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
)
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Whole texts of the licenses that are short enough to be pasted whole.
TEMPLATES += (
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY),
    ("BSD-2-text", _BSD_2 + _BSD_END),
    ("BSD-3-text", _BSD_2 + _BSD_3 + _BSD_END),
    ("GPL-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
)
#: Chance that the bands miss a match.
MISS = 1e-6
#: Minima of templates, candidate texts and bands of templates up to which they are broadcast.
BROADCAST_ROWS = 200_000
MARKS = ".,;:()\"'"


def _shingles(text: Column, size: int) -> Column:
    return shingle_hashes(words(F.translate(ascii_lower(text), MARKS, "")), size)


def _classes(sizes: list[int], percent: int) -> list[tuple[int, int, int, int]]:
    """(upper bound, step, window, bands) of each size class in use."""
    found = []
    for upper in sorted({1 << (n - 1).bit_length() for n in sizes}):
        step = max(1, upper // 4)
        window = upper + step - 1
        least = upper // 2 + 1
        held = math.ceil(least * percent / 100)
        similarity = held / (window + least - held)
        bands = 1 if similarity >= 1 else math.ceil(math.log(MISS) / math.log(1 - similarity))
        found.append((upper, step, window, bands))
    return found


def _minima(values: Column, bands: Column) -> Column:
    """Of ``values``, the one with the least hash under each of ``bands`` hash functions."""
    seeds = F.sequence(F.lit(1), bands)
    return F.transform(seeds, lambda k: F.array_min(F.transform(values, lambda h: F.struct(F.xxhash64(h, k).alias("hash"), h.alias("shingle"))))["shingle"])


def _small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it is proven small."""
    return F.broadcast(df) if fits(df, BROADCAST_ROWS) else df


def _sized(whole: DataFrame, percent: int) -> tuple[DataFrame, dict[int, tuple[int, int, int]]]:
    """Templates with their class ``upper``, and each class's step, window and bands."""
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles")))).cast("int")
    sized = whole.withColumn("upper", upper)
    used = [r.upper for r in sized.select("upper").distinct().collect()]  # powers of two: a few rows
    return sized, {u: rest for u, *rest in _classes(used, percent)}


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] | DataFrame = TEMPLATES, size: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, template, place, n_shared, n_shingles): the first best window of each template found.

    ``templates`` are pairs or a table (template, text); one of fewer than ``size`` words matches nothing, and
    texts under one name are alternatives of which the best is reported. ``place`` is the word at which the
    window begins.
    """
    given = templates if isinstance(templates, DataFrame) else docs.sparkSession.createDataFrame(list(templates), "template string, text string")
    whole = given.where(F.size(words(F.col("text"))) >= size).select("template", F.array_distinct(_shingles(F.col("text"), size)).alias("shingles"))
    sized, classes = _sized(cut(whole.select(F.monotonically_increasing_id().alias("no"), "*")), percent)
    if not classes:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, template string, place int, n_shared bigint, n_shingles bigint")
    step, width, bands = (F.create_map(*[F.lit(x) for u, c in classes.items() for x in (u, c[k])]) for k in range(3))
    keys = cut(sized.select("no", "upper", F.posexplode(_minima(F.col("shingles"), F.element_at(bands, F.col("upper")))).alias("band", "least")))

    plain = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    probes = plain.select("doc_id", "version", F.explode(F.array_distinct(_shingles(F.col("text"), size))).alias("shingle"))
    sketch = cut(keys.select("upper", F.col("least").alias("shingle")).distinct())
    found_in = [F.col("doc_id").alias("h_doc"), F.col("version").alias("h_version"), "upper"]
    hits = cut(probes.join(_small(sketch), "shingle").groupBy(*found_in).agg(F.collect_set("shingle").alias("hits")))
    same = F.col("doc_id").eqNullSafe(F.col("h_doc")) & (F.col("version") == F.col("h_version"))
    met = plain.join(_small(hits), same).select("doc_id", "version", "upper", "hits", _shingles(F.col("text"), size).alias("own"))

    # The windows of a class in which something of its templates was found. Coalesced, or the optimizer would have
    # ``own`` tested for NULL, and so made, for every text before the join.
    places = F.sequence(F.lit(0), F.greatest(F.size("own") - 1, F.lit(0)), F.element_at(step, F.col("upper")))
    windows = met.select("doc_id", "version", "upper", "own", "hits", F.explode(places).alias("place"))
    windows = windows.withColumn("part", F.slice("own", F.col("place") + 1, F.element_at(width, F.col("upper")))).where(F.coalesce(F.arrays_overlap("part", "hits"), F.lit(False)))
    banded = windows.select("doc_id", "version", "upper", "place", "part", F.posexplode(_minima(F.col("part"), F.element_at(bands, F.col("upper")))).alias("band", "least"))
    met_once = banded.join(_small(keys), ["upper", "band", "least"]).groupBy("doc_id", "version", "upper", "place", "no").agg(F.first("part").alias("part"))
    hit = met_once.join(_small(sized.select("no", "template", "shingles")), "no").withColumn("n_shared", F.size(F.array_intersect("part", "shingles")))
    hit = hit.where(F.col("n_shared") * 100 >= F.size("shingles") * percent)
    found = hit.select("doc_id", "version", "template", "place", "n_shared", F.size("shingles").alias("n_shingles"))
    best = F.max(F.struct("n_shared", (-F.col("place")).alias("at"), "n_shingles")).alias("best")
    out = found.groupBy("doc_id", "version", "template").agg(best)
    return out.select("doc_id", "template", (-F.col("best.at")).alias("place"), F.col("best.n_shared").cast("bigint").alias("n_shared"), F.col("best.n_shingles").cast("bigint").alias("n_shingles"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("place")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL = rf"""
WITH t AS (
  SELECT doc_id, NULL AS template, text FROM documents
  UNION ALL SELECT NULL, template, text FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEMPLATES)}) v(template, text)
), w AS (
  SELECT doc_id, template, regexp_extract_all(translate(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:()"''', ''), '[^\x20\x09-\x0D]+') AS w FROM t
), s AS MATERIALIZED (
  SELECT doc_id, template, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, template, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
), b AS (SELECT DISTINCT template, g FROM s WHERE template IS NOT NULL),
sizes AS (SELECT template, count(*) AS n, CASE WHEN count(*) = 1 THEN 1 ELSE 2 ** ceil(log2(count(*))) END::INT AS u FROM b GROUP BY template),
hit AS (
  SELECT s.doc_id, s.i - 1 AS i, b.template, b.g FROM s JOIN b ON b.g = s.g WHERE s.doc_id IS NOT NULL
), win AS (
  SELECT hit.doc_id, hit.template, n, p, count(DISTINCT g) AS shared
  FROM hit JOIN sizes USING (template),
       LATERAL (SELECT unnest(range(greatest(0, ((i - (u + greatest(1, u // 4) - 1) + greatest(1, u // 4)) // greatest(1, u // 4)) * greatest(1, u // 4)), i + 1, greatest(1, u // 4))) AS p)
  GROUP BY ALL
)
SELECT doc_id, template, max(shared)::BIGINT AS n_shared, any_value(n)::BIGINT AS n_shingles
FROM win WHERE 100 * shared >= 80 * n GROUP BY doc_id, template
"""
