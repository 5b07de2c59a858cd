"""Licence scan by canonical digest lookup.

A text's canonical form has its letters in lower case, punctuation turned into
spaces, copyright lines dropped, equivalent spellings made one, and its words
joined by single spaces.  The sha-256 of the form is the text's digest.

Entire texts are looked up, never parts of a sentence: the document as a
whole, each of its paragraphs (blocks between empty lines), each run of
neighbouring paragraphs and each of its lines.  Known licences become (digest, licence) rows by the same function.
Documents are read once; a paragraph, run or line is hashed only if its number
of words is that of some known licence, which loses nothing.  The digests are
hash-joined to the known ones (Spark broadcasts these by their size; beyond
that the join is an ordinary shuffle whose hot digests AQE splits), after each
document has counted its equal digests.

Defined results: null and empty texts have the empty form and no licence; a
known licence without words matches nothing; known rows with one digest count
as the first licence id in order; repeated documents get a row each; columns
beside doc_id and text (license_id and text) are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import stored, text_bytes

# Known licences (SPDX ids), as notices of one line and as whole short texts.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_TERMS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.

"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by
the Free Software Foundation, either version {2} of the License, or (at your option) any later version.

This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.

You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE_LINK = "\n\nFor more information, please refer to <https://unlicense.org/>"
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_BSL = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is
furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a
source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT
HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
LICENSES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, version 2.0."),
    ("Apache-2.0", _APACHE_NOTICE),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_TERMS),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted.\n\n" + _ISC_TERMS),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("MIT", "The MIT License\n\n" + _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("MPL-2.0", _MPL.replace("\n", " ")),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_NAMES + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_START + _BSD_NAMES + _BSD_END),
    *[(i, _GNU.format(thing, name, version)) for thing in ("program", "library")
      for i, name, version in (("GPL-2.0-or-later", "General Public License", "2"),
                               ("GPL-3.0-or-later", "General Public License", "3"),
                               ("LGPL-2.1-or-later", "Lesser General Public License", "2.1"),
                               ("LGPL-3.0-or-later", "Lesser General Public License", "3"),
                               ("AGPL-3.0-or-later", "Affero General Public License", "3"))],
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + _UNLICENSE_LINK),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    ("BSL-1.0", _BSL),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + _BSL),
]

# Equivalent spellings, of words and of word pairs.
SPELLINGS = dict(zip(
    b"licence licences licenced licencing sublicence sublicences acknowledgement analyse artefact authorisation authorised "
    b"catalogue centre favour fulfil fulfilment initialise judgement labour modelled offence optimise organisation organise "
    b"practise programme recognise utilisation whilst wilful http".split(),
    b"license licenses licensed licensing sublicense sublicenses acknowledgment analyze artifact authorization authorized "
    b"catalog center favor fulfill fulfillment initialize judgment labor modeled offense optimize organization organize "
    b"practice program recognize utilization while willful https".split(), strict=True))
PAIRS = ((b"sub license", b"sublicense"), (b"sub licence", b"sublicense"), (b"non commercial", b"noncommercial"),
         (b"copyright owner", b"copyright holder"), (b"per cent", b"percent"))

# ASCII letters to lower case; other ASCII but digits and line ends to spaces; all other bytes stay.
_FOLD = bytes(b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 or b == 10 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))
_RIGHTS = re.compile(rb"^ *(\xc2\xa9|c? *copyright +(c |\xc2\xa9 *|[12][0-9]{3}|by )|all rights reserved *$)")


def canonical_lines(text: bytes) -> list[list[bytes]]:
    """The canonical words of every line; a copyright line has none (as an empty line, but it ends no paragraph: None)."""
    folded = text.translate(_FOLD)
    for pair, one in PAIRS:
        folded = folded.replace(pair, one)
    out = []
    for line in folded.split(b"\n"):
        if (b"copyright" in line or b"rights" in line or b"\xc2\xa9" in line) and _RIGHTS.match(line):
            out.append(None)
        else:
            out.append([SPELLINGS.get(w, w) for w in line.split()])
    return out


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def units(lines: list[list[bytes] | None], sizes: set[int]) -> Counter:
    """Digests of the lines, paragraphs and runs of paragraphs with a known
    number of words, counted (a run within a longer one counts too)."""
    found: Counter = Counter()
    words: list[bytes] = []         # of all paragraphs
    edges = [0]                     # where they end
    most = max(sizes, default=0)
    block: list[bytes] = []
    n_lines = 0
    for line in [*lines, []]:
        if line is None:
            continue
        if line:
            if len(line) in sizes:
                found[digest(line)] += 1
            block += line
            n_lines += 1
        else:
            if n_lines > 1 and len(block) in sizes:
                found[digest(block)] += 1
            if block:
                words += block
                edges.append(len(words))
            block, n_lines = [], 0
    for i, start in enumerate(edges):
        for j in range(i + 2, len(edges)):
            end = edges[j]
            if end - start > most:
                break
            if end - start in sizes:
                found[digest(words[start:end])] += 1
    return found


def known_licenses(spark: SparkSession) -> DataFrame:
    """license_id, text: the built-in list."""
    return spark.createDataFrame(LICENSES, "license_id string, text string")


def known_digests(known: DataFrame) -> DataFrame:
    """digest, license_id, n_words: one row per canonical form."""
    def run(batches):
        for batch in batches:
            forms = [[w for line in canonical_lines(t.as_py()) if line for w in line] for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(digest, forms), pa.string()), batch["license_id"], pa.array(map(len, forms), pa.int32())],
                ["digest", "license_id", "n_words"])
    rows = known.select("license_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(
        run, "digest string, license_id string, n_words int")
    return rows.filter("n_words > 0 and license_id is not null").groupBy("digest").agg(
        F.min("license_id").alias("license_id"), F.first("n_words").alias("n_words"))


def license_scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_license (of the whole text), n_units
    (lines, paragraphs and runs of paragraphs that are licences), licenses (ids found, in order),
    canonical_sha256."""
    known = stored(known_digests(known_licenses(docs.sparkSession) if known is None else known), "known-licenses")
    sizes = {r["n_words"] for r in known.select("n_words").distinct().toLocalIterator()}     # numbers of words only

    def run(batches):
        for batch in batches:
            rows, whole, digests, counts = [], [], [], []
            for row, doc_id, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"]):
                lines = canonical_lines(text.as_py())
                form = digest([w for line in lines if line for w in line])
                found = units(lines, sizes)
                for d, n, is_whole in [(form, 0, True), *((d, n, False) for d, n in found.items())]:
                    rows.append((row, doc_id))
                    digests.append(d)
                    counts.append(n)
                    whole.append(is_whole)
            cols = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(digests, pa.string()),
                 pa.array(counts, pa.int64()), pa.array(whole, pa.bool_())], ["row", "doc_id", "digest", "n", "whole"])

    keyed = text_bytes(docs.withColumn("_row", F.monotonically_increasing_id()), F.col("_row").alias("row"))
    looked = keyed.mapInArrow(run, "row bigint, doc_id bigint, digest string, n bigint, whole boolean").join(
        known.select("digest", "license_id"), "digest", "left")
    # the rows of a document come from one task: the partial aggregate makes one row of them
    return looked.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max(F.when(F.col("whole"), F.col("license_id"))).alias("text_license"),
        F.sum(F.when(F.col("license_id").isNotNull(), F.col("n")).otherwise(0)).alias("n_units"),
        F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("licenses"),
        F.max(F.when(F.col("whole"), F.col("digest"))).alias("canonical_sha256")).drop("row")
