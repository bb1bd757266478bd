"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from math import log, sqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import as_bytes, slices
from loomline.session import cut, ship

_GNU = "This program is free software%s you can redistribute it and/or modify it under the terms of the GNU %sGeneral Public License as published by the Free Software Foundation%s either version %s of the License, or (at your option) any later version."
_GNU_OPENING = "GNU %sGENERAL PUBLIC LICENSE Version %s Copyright (C) %s Free Software Foundation, Inc. %sEveryone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_OLD_HOME = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA "
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC = _ISC_GRANT + """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: Notices, headers and whole texts by licence; the long texts (Apache, GNU, MPL, CC0) by their openings.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-or-later", _GNU % (":", "Affero ", ",", "3"), _GNU_OPENING % ("AFFERO ", "3, 19 November 2007", "2007", "https://fsf.org/ ")),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "SPDX-License-Identifier: Apache-2.0",
        _APACHE,
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    "BSD-2-Clause": (_BSD_TERMS + _BSD_DISCLAIMER, "SPDX-License-Identifier: BSD-2-Clause"),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "SPDX-License-Identifier: BSD-3-Clause",
        _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER,
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "CC0-1.0": (
        "Dedicated to the public domain under CC0 1.0.",
        "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
        'Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT\'S ACCEPTANCE OF THIS AGREEMENT.',
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", _GNU % (";", "", ";", "2"), _GNU_OPENING % ("", "2, June 1991", "1989, 1991", _OLD_HOME)),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        _GNU_OPENING % ("", "3, 29 June 2007", "2007", "https://fsf.org/ "),
    ),
    "ISC": (_ISC, _ISC_GRANT, "SPDX-License-Identifier: ISC"),
    "LGPL-2.1": (_GNU.replace("program", "library") % (";", "Lesser ", ";", "2.1"), _GNU_OPENING % ("LESSER ", "2.1, February 1999", "1991, 1999", _OLD_HOME)),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-or-later", _GNU % (":", "Lesser ", ",", "3"), _GNU_OPENING % ("LESSER ", "3, 29 June 2007", "2007", "https://fsf.org/ ")),
    "MIT": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
        "SPDX-License-Identifier: MIT",
        _MIT,
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
}
LEAST = 0.8
#: Base names of files whose licence holds for their directory.
LICENCE_FILE = r"(?i)^(?:licen[cs]e|copying|notice)(?:[-._].*)?$"

#: Tokens whose counts a task holds at a time.
COUNTED = 200_000
PASSAGES = "array<struct<rank:int,dot:double,known:double,others:array<struct<token:string,tf:double>>>>"
_OTHERS = pa.list_(pa.struct([("token", pa.string()), ("tf", pa.float64())]))
_PASSAGES = pa.list_(pa.struct([("rank", pa.int32()), ("dot", pa.float64()), ("known", pa.float64()), ("others", _OTHERS)]))

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 10 if c == 10 else 32 for c in range(256))
_SENTENCE = re.compile(rb"(?<=[.!?:;])[ \t]+")
_WRAPPED = re.compile(rb"(?<=[.!?:;])\s+")


def tokens_of(text: bytes) -> list[bytes]:
    """Runs of a-z and 0-9, after A-Z in lower case."""
    return text.translate(_KEEP).split()


class Stated(NamedTuple):
    """A passage near a template: cosine is dot / sqrt(known + the squares of the others' weights).

    ``rank`` is the first template of the licence; ``others`` are the tokens that no template has, as 1 + log(n).
    """

    rank: int
    dot: float
    known: float
    others: dict[bytes, float]
    most: float
    surely: float


class Index:
    """Templates as unit vectors of TF-IDF weights, inverted by token.

    ``counts`` are documents by token, of ``total``, for the templates' tokens. A token that no template has, but a
    document, is in 1 to ``total`` documents: that bounds a passage's cosine until its count is known.
    ``prefix`` holds, for each template, its heaviest tokens, so many that what a text without any of them can share
    with the template stays below ``least``: a passage without one needs no scoring.
    """

    def __init__(self, templates: Mapping[str, Iterable[str]], counts: Mapping[bytes, int], total: int, least: float):
        self.total, self.counts, self.least = total, counts, least
        self.names: list[str] = []
        self.postings: dict[bytes, list[tuple[int, float]]] = {}
        self.prefix: set[bytes] = set()
        #: Templates by prefix token; number of tokens and squared unit weights by token of each template.
        self.led: dict[bytes, list[int]] = {}
        self.sizes: list[int] = []
        self.shares: list[dict[bytes, float]] = []
        for name, texts in templates.items():
            for text in texts:
                tokens = tokens_of(text.encode())
                weights = self.weights(tokens)
                norm = sqrt(sum(x * x for x in weights.values()))
                rest = norm * norm
                for token in sorted(weights, key=lambda x: (-weights[x], x)):
                    self.postings.setdefault(token, []).append((len(self.names), weights[token] / norm))
                    if rest >= (least * norm) ** 2 - 1e-9:
                        self.prefix.add(token)
                        self.led.setdefault(token, []).append(len(self.names))
                    rest -= weights[token] ** 2
                self.sizes.append(len(tokens))
                self.shares.append({x: (y / norm) ** 2 for x, y in weights.items()})
                self.names.append(name)

    def weight(self, token: bytes, n: int) -> float:
        return (1 + log(n)) * (log((1 + self.total) / (1 + self.counts.get(token, 0))) + 1)

    def weights(self, tokens: Iterable[bytes]) -> dict[bytes, float]:
        return {x: self.weight(x, n) for x, n in Counter(tokens).items()}

    def stated(self, tokens: list[bytes], only: int | None = None) -> Stated | None:
        """The nearest template, or ``only``, and what its cosine is made of, unless that can't reach the least; ties to the first name."""
        if self.prefix.isdisjoint(tokens):
            return None
        known, dots, others = 0.0, Counter(), {}
        for token, n in Counter(tokens).items():
            if token in self.postings:
                weight = self.weight(token, n)
                known += weight * weight
                for k, other in self.postings[token]:
                    dots[k] += weight * other
            else:
                others[token] = 1 + log(n)
        k = min(dots, key=lambda x: (-round(dots[x], 9), self.names[x])) if only is None else only
        open_ = sum(x * x for x in others.values())
        most, surely = dots[k] / sqrt(known + open_), dots[k] / sqrt(known + open_ * (log((1 + self.total) / 2) + 1) ** 2)
        return Stated(self.names.index(self.names[k]), dots[k], known, others, most, surely) if most >= self.least else None

    def passages(self, text: bytes) -> Iterator[list[bytes]]:
        """Tokens of the whole text, of its paragraphs and lines and of their sentences, where a prefix token is among them.

        A paragraph ends at a line without a token, such as the bare mark of a comment.
        """
        tokens = tokens_of(text)
        if self.prefix.isdisjoint(tokens):
            return
        yield tokens
        block: list[bytes] = []
        for line in [*text.split(b"\n"), b""]:
            own = tokens_of(line)
            if not self.prefix.isdisjoint(own):
                yield own
                yield from map(tokens_of, _SENTENCE.split(line))
            if own:
                block.append(line)
                continue
            if len(block) > 1:
                whole = b"\n".join(block)
                own = tokens_of(whole)
                if not self.prefix.isdisjoint(own):
                    yield own
                    yield from map(tokens_of, _WRAPPED.split(whole))
            block = []

    def windows(self, tokens: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
        """Windows of the tokens that are as long as a template and may reach the least with it, wherever lines break.

        A window has one of the template's prefix tokens, and the squared unit weights of the template's tokens that
        it holds add up to the least's square: a cosine is at most the root of that sum.
        """
        places: dict[int, list[int]] = {}
        for i, token in enumerate(tokens):
            for k in self.led.get(token, ()):
                places.setdefault(k, []).append(i)
        for k, at in places.items():
            size, shares, last = self.sizes[k], self.shares[k], -1
            if size > len(tokens) or sum(shares[x] for x in shares.keys() & set(tokens)) < self.least**2 - 1e-9:
                continue
            spans: list[list[int]] = []  # stretches of the tokens whose windows hold a prefix token
            for i in at:
                if spans and i - size + 1 <= last:
                    spans[-1][1] = min(i + size, len(tokens))
                else:
                    spans.append([max(0, i - size + 1), min(i + size, len(tokens))])
                last = i + 1
            for start, end in spans:
                held: Counter = Counter()
                for i in range(start, end):
                    if tokens[i] in shares:
                        held[tokens[i]] += 1
                    if i - size >= start and (gone := tokens[i - size]) in shares:
                        held[gone] -= 1
                        if not held[gone]:
                            del held[gone]
                    if i - size + 1 >= start and sum(shares[x] for x in held) >= self.least**2 - 1e-9:
                        yield k, tokens[i - size + 1 : i + 1]

    def scan(self, text: bytes) -> list[Stated]:
        """The passages and windows that may be the best of the text; all but one are left out where the counts so far decide."""
        tokens = tokens_of(text)
        if self.prefix.isdisjoint(tokens):
            return []
        found = [x for x in map(self.stated, self.passages(text)) if x]
        found += [x for k, window in self.windows(tokens) if (x := self.stated(window, k))]
        surely = max((x.surely for x in found), default=0.0) - 1e-9
        found = list({(x.rank, x.dot, x.known, tuple(x.others.items())): x for x in found if x.most >= surely}.values())
        if any(x.others for x in found):
            return found
        return sorted(found, key=lambda x: (-round(x.most, 9), x.rank))[:1]


def scan_licences(files: DataFrame, templates: Mapping[str, Iterable[str]] = TEMPLATES, least: float = LEAST, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(doc_id, path, direct, score): the licence that each file's own text states, null if none.

    Document frequencies are those of all tokens in all files: they are counted in a table, of which the templates'
    tokens go to the driver. The few passages near a template that hold further tokens are joined with the table.
    """
    ship(files.sparkSession)
    rows = files.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"), F.col(text_col).alias("text")
    )

    def listed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x.decode() for x in counts], pa.string()), pa.array(counts.values(), pa.int64())], ["token", "n"]
        )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in slices(batches):
            for text in as_bytes(batch.column("text")):
                counts.update({b"", *tokens_of(text)})
                if len(counts) >= COUNTED:
                    yield listed(counts)
                    counts = Counter()
        yield listed(counts)

    # the empty token is in every file
    counted = cut(rows.select("text").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")))
    wanted = {x.decode() for texts in templates.values() for text in texts for x in tokens_of(text.encode())}
    counts = {x["token"].encode(): x["n"] for x in counted.where(F.col("token").isin(["", *sorted(wanted)])).collect()}
    total = counts.pop(b"", 0)
    index = Index(templates, counts, total, least)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            passages = [
                [{"rank": x.rank, "dot": x.dot, "known": x.known, "others": [{"token": t.decode(), "tf": w} for t, w in x.others.items()]} for x in index.scan(text)]
                for text in as_bytes(batch.column("text"))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("path"), pa.array(passages, _PASSAGES)], ["doc_id", "path", "passages"])

    scanned = cut(rows.mapInArrow(scan, f"doc_id long, path string, passages {PASSAGES}")).withColumn("row", F.monotonically_increasing_id())
    near = scanned.select("row", F.posexplode("passages").alias("at", "p")).select("row", "at", "p.*")
    others = near.select("row", "at", F.explode("others").alias("o")).select("row", "at", "o.*")
    idf = F.log((1 + F.lit(total)) / (1 + F.col("n"))) + 1
    known = cut(counted.join(others.select("token").distinct(), "token", "left_semi").select("token", idf.alias("idf")))
    squares = others.join(known, "token").groupBy("row", "at").agg(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("open"))
    cosine = F.col("dot") / F.sqrt(F.col("known") + F.coalesce("open", F.lit(0.0)))
    scored = near.drop("others").join(squares, ["row", "at"], "left").withColumn("score", cosine).where(F.col("score") >= least)
    order = F.struct((-F.round("score", 9)).alias("k"), "rank", "score")
    name = F.element_at(F.array(*(F.lit(x) for x in index.names)), F.col("best.rank") + 1)
    best = cut(scored.groupBy("row").agg(F.min(order).alias("best")).select("row", name.alias("direct"), "best.score"))
    return scanned.drop("passages").join(best, "row", "left").select("doc_id", "path", "direct", "score")


def inherit(scanned: DataFrame) -> DataFrame:
    """``scanned`` with licence, origin (header, file, inherited, none) and from_dir.

    A file's own licence comes first. Else it has that of the nearest directory above it (its own included) in which
    a licence file states one; of several there, the one of the highest score, then of the first name.
    """
    named = cut(
        scanned.withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")).withColumn("name", F.regexp_extract("path", "[^/]*$", 0))
    )
    licensing = F.col("name").rlike(LICENCE_FILE) & F.col("direct").isNotNull()
    best = F.min(F.struct((-F.round("score", 9)).alias("k"), "direct")).alias("best")
    of_dir = cut(
        named.where(licensing).groupBy(F.col("dir").alias("from_dir")).agg(best).select("from_dir", F.col("best.direct").alias("handed"))
    )
    parts = F.split("dir", "/")
    above = F.concat(
        F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    )
    ancestors = named.select("dir").distinct().select("dir", F.posexplode(above).alias("depth", "from_dir"))
    nearest = ancestors.join(of_dir, "from_dir").groupBy("dir").agg(F.max(F.struct("depth", "from_dir", "handed")).alias("of"))
    nearest = cut(nearest.select("dir", "of.from_dir", "of.handed"))
    own = F.col("direct").isNotNull()
    origin = F.when(own & F.col("name").rlike(LICENCE_FILE), "file").when(own, "header").when(F.col("handed").isNotNull(), "inherited").otherwise(
        "none"
    )
    return named.join(nearest, "dir", "left").select(
        "doc_id",
        "path",
        F.coalesce("direct", "handed").alias("licence"),
        "score",
        origin.alias("origin"),
        F.when(~own, F.col("from_dir")).alias("from_dir"),
    )


def licence_scan(files: DataFrame, **how) -> DataFrame:
    """doc_id, path, licence, score (cosine, of a file's own text), origin and from_dir of each file.

    A null or empty text states no licence; a null path is a file in the root directory. Texts of any length are scanned
    whole. Of equally near licences the first by name is stated, and the first of equally near ones in a directory is
    handed down. Null ids and repeated rows are scanned like any other; further columns have no part, whatever their
    names. An empty table gives an empty result.
    """
    return inherit(scan_licences(files, **how))
