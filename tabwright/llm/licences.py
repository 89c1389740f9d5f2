"""Licence scans: lines and whole texts against licence templates by word-bigram Dice.

Everything here is DataFrame functions; a value that is used twice goes through a
one-element array and ``explode``, which computes it once.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts of public licences and the usual notices that name them.
TEMPLATES = {
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "MIT/notice": "Released under the MIT License.",
    "MIT/licensed": "Licensed under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
        "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
        "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause/text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. THIS "
        "SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
        "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause/text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. Neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. THIS "
        "SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
        "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
        "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause/notice": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause/notice": "Licensed under the BSD 2-Clause License.",
    "GPL-3.0/notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0/notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should "
        "have received a copy of the GNU General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/."
    ),
    "GPL-2.0/header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version. This program is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should "
        "have received a copy of the GNU General Public License along with this program; if not, write to "
        "the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
    ),
    "LGPL-3.0/notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0/notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0/notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0/notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0/notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0/notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0/sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0/notice": "This work is dedicated to the public domain under CC0 1.0.",
    "Unlicense/text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "reserved": "All rights reserved.",
}

NOT_WORD = r"[^\p{L}\p{N}]+"


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, which is plain ASCII."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _once(df: DataFrame, column, name: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(F.array(column)).alias(name))


def licence_matches(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8
) -> DataFrame:
    """(doc_id, license_id, n_segments, best_dice): every licence found in every document.

    The segments of a document are its lines, its whole text if it has several lines, and
    passages that do not overlap, see ``_passages``. Text is
    lower-cased and all but letters and digits count as one space. Dice is twice the common
    distinct bigrams over the sum of both counts; a segment with a bigram count outside
    ``least / (2 - least)`` to ``(2 - least) / least`` times a template's cannot reach
    ``least``, so such templates are never compared, and distinct words bound the count
    before any bigram is made. Of all templates that a segment matches only the best one
    counts (greatest Dice, then the first id). Null and empty texts, and segments of one word, match nothing.
    Repeated rows of one doc_id count as one document; a null doc_id is a document too.
    Documents are read and cut once; only those near a template are compared, see ``_near``.
    """
    keep = ("doc_id", "others")
    # words of each line
    lines = _once(
        _near(docs, templates, least), F.transform(F.split("text", "\n"), lambda x: F.split(_normal(x), " ")), "lines", *keep
    )
    best = _once(_segments(lines, templates, least), _best(least), "best", *keep, "lines")
    pairs = best.select("doc_id", "others", "lines", "best", F.explode("others").alias("t"))
    own = F.filter("best", lambda m: m["id"] == F.col("t.id"))
    pairs = _once(pairs, F.transform(own, lambda m: m["dice"]), "whole", "doc_id", "t", "others", "lines")
    return (
        _passages(pairs, least)
        .select(
            "doc_id",
            F.col("t.id").alias("license_id"),
            F.array_max(F.concat("whole", F.transform("found", lambda r: r["dice"]))).alias("dice"),
            (F.size("whole") + _apart("found")).alias("n"),
        )
        .groupBy("doc_id", "license_id")
        .agg(F.sum("n").alias("n_segments"), F.max("dice").alias("best_dice"))
    )


def _normal(text):
    return F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " "))


def _bigrams(words):
    """Word bigrams of an array in order, with repeats."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)),
    )


def _dice(bigrams, known):
    """Dice of distinct bigrams; 0 when there are none."""
    own = F.array_distinct(bigrams)
    return (2 * F.size(F.array_intersect(own, known))) / (F.size(own) + F.size(known))


def _near(docs: DataFrame, templates: dict[str, str], least: float) -> DataFrame:
    """(doc_id, text, others): documents that can match a template, and all such templates.

    A segment or passage reaches ``least`` only with a share of ``least / (2 - least)`` of the
    template's bigrams. All its bigrams are bigrams of the whole text, so a text without that
    many matches the template nowhere.
    """
    ratio = (2 - least) / least
    known = {k: template_bigrams(v) for k, v in templates.items()}
    length = {k: len(re.sub(r"[^a-z0-9]+", " ", v.lower()).split()) - 1 for k, v in templates.items()}
    need = {k: math.ceil(len(v) / ratio - 1e-9) for k, v in known.items()}
    table = F.array(
        *(
            F.struct(
                F.lit(k).alias("id"),
                F.lit(-place).alias("place"),
                F.array(*map(F.lit, v)).alias("bigrams"),
                F.lit(need[k]).alias("need"),
                F.lit(length[k]).alias("length"),
                F.lit(max(length[k], int(length[k] * ratio))).alias("longest"),
            )
            for place, (k, v) in enumerate(sorted(known.items()))
        )
    )
    every = sorted(set().union(*known.values()))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    keep = ("doc_id", "text")
    words = _once(texts, F.split(_normal("text"), " "), "w", *keep)
    hits = _once(words, F.array_distinct(F.filter(_bigrams(F.col("w")), lambda b: b.isin(every))), "hits", *keep)
    enough = F.filter(table, lambda t: F.size(F.array_intersect(F.col("hits"), t["bigrams"])) >= t["need"])
    near = _once(hits.filter(F.size("hits") >= min(need.values())), enough, "others", *keep)
    return near.filter(F.size("others") > 0)


def _segments(lines: DataFrame, templates: dict[str, str], least: float) -> DataFrame:
    """Adds ``own``: the distinct bigrams of each line and of a whole text of several lines.

    Segments that are too short or too long for any template are left out.
    """
    ratio = (2 - least) / least
    counts = [len(template_bigrams(v)) for v in templates.values()]
    whole = F.filter(F.flatten("lines"), lambda w: w != "")
    segments = F.when(F.size("lines") > 1, F.concat("lines", F.array(whole))).otherwise(F.col("lines"))
    fitting = F.filter(
        segments,
        lambda w: (F.size(w) > 1)
        & (F.size(w) - 1 >= min(counts) / ratio)
        & (F.size(F.array_distinct(w)) - 1 <= max(counts) * ratio),
    )
    keep = ("doc_id", "others", "lines")
    return _once(
        _once(lines, fitting, "fitting", *keep),
        F.transform("fitting", lambda w: F.array_distinct(_bigrams(w))),
        "own",
        *keep,
    )


def _best(least: float):
    """The best template of each segment in ``own``, where it reaches ``least``."""
    ratio = (2 - least) / least

    def best(b):
        fitting = F.filter(
            "others",
            lambda t: (F.size(t["bigrams"]) <= F.size(b) * ratio) & (F.size(b) <= F.size(t["bigrams"]) * ratio),
        )
        # the greatest Dice, of equal ones the first id: its negated place sorts it last
        return F.array_max(
            F.transform(
                fitting,
                lambda t: F.struct(
                    (2 * F.size(F.array_intersect(b, t["bigrams"])) / (F.size(b) + F.size(t["bigrams"]))).alias("dice"),
                    t["place"].alias("place"),
                    t["id"].alias("id"),
                ),
            )
        )

    return F.filter(F.transform("own", best), lambda m: m["dice"] >= least)


def _passages(pairs: DataFrame, least: float) -> DataFrame:
    """(doc_id, t, whole, found): licences inside longer lines or over several lines.

    A passage is a run of consecutive words, across line ends, that starts at a bigram of the
    template and has as many words as the template, or ends at one of its bigrams and has at
    most ``(2 - least) / least`` times as many. Lines that match the template by themselves
    are gaps here, and a text that matches as a whole has no passages. A run that another
    template matches better (or as well, with an earlier id) is not this template's. ``found``
    has all runs by their ends. Runs are compared only where a share of
    ``least / (2 - least)`` of the template's bigrams, without which Dice cannot reach
    ``least``, lies close enough together. Pairs with neither runs nor whole segments go.
    """
    keep = ("doc_id", "t", "others", "whole")
    matches = lambda b: _dice(b, F.col("t.bigrams")) >= least
    lines = _once(pairs, F.filter(F.flatten("lines"), lambda w: w != ""), "w", *keep, "lines")
    lines = _once(lines, _bigrams(F.col("w")), "b", *keep, "lines")
    # a line that matches alone becomes a word that no text has
    gaps = F.transform(
        "lines",
        lambda x: F.when((F.size(x) > F.col("t.need")) & matches(_bigrams(x)), F.array(F.lit("|"))).otherwise(x),
    )
    none = F.array().cast("array<string>")
    rest = F.when(matches(F.col("b")), none).otherwise(F.filter(F.flatten(gaps), lambda w: w != ""))
    rest = _once(lines, rest, "w", *keep)
    rest = _once(rest, F.when(F.size("w") > F.col("t.length"), _bigrams(F.col("w"))).otherwise(none), "b", *keep)
    at = F.filter(
        F.transform("b", lambda x, i: F.when(F.array_contains("t.bigrams", x), i)), lambda i: i.isNotNull()
    )
    rest = _once(rest, at, "at", *keep, "b")

    def runs(i, k):
        """(end, dice) of the runs that start at hit ``k``, which is bigram ``i``."""
        close = F.get("at", k + F.col("t.need") - 1) - i < F.col("t.longest")
        start = F.least(i, F.size("b") - F.col("t.length"))
        ends = F.filter(
            F.slice("at", k + 1, F.col("t.longest")),
            lambda e: (e - start >= F.col("t.length")) & (e - start < F.col("t.longest")),
        )
        ends = F.concat(F.array(start + F.col("t.length") - 1), ends)
        return F.when(
            close,
            F.transform(
                ends,
                lambda e: F.struct(
                    e.alias("end"),
                    start.alias("start"),
                    _dice(F.slice("b", start + 1, e - start + 1), F.col("t.bigrams")).alias("dice"),
                ),
            ),
        ).otherwise(F.array().cast("array<struct<end:int,start:int,dice:double>>"))

    found = _once(
        rest,
        F.array_sort(F.filter(F.flatten(F.transform("at", runs)), lambda r: r["dice"] >= least)),
        "found",
        *keep,
        "b",
    )

    def beaten(r):
        """True when another template matches the words of a run better."""
        own = F.slice("b", r["start"] + 1, r["end"] - r["start"] + 1)
        other = lambda o: _dice(own, o["bigrams"])
        return F.exists(
            F.filter("others", lambda o: o["id"] != F.col("t.id")),
            lambda o: (other(o) > r["dice"]) | ((other(o) == r["dice"]) & (o["id"] < F.col("t.id"))),
        )

    found = _once(found, F.filter("found", lambda r: ~beaten(r)), "found", "doc_id", "t", "whole")
    return found.filter((F.size("found") > 0) | (F.size("whole") > 0))


def _apart(found):
    """The most runs that do not overlap."""
    return F.aggregate(
        found,
        F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n")),
        lambda a, r: F.when(
            r["start"] > a["end"], F.struct(r["end"].alias("end"), (a["n"] + 1).alias("n"))
        ).otherwise(a),
    )["n"]
