"""Licence scan: a positional index of licence words, looked up by each file's rarest ones."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import ascii_lower, packed, split_words, text_or_empty

#: Fixed by the contract of the queries: what stands between words, and the base phrases with their labels.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


@dataclass(frozen=True)
class Template:
    """A licence notice, and the phrases, in their order, without which it is not that licence."""

    label: str
    text: str
    phrases: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return re.findall("[0-9a-z]+", self.text.lower())


BASE_TEMPLATES = tuple(Template(label, phrase, (phrase,)) for label, phrase in BASE.items())

#: Public notices in their usual wording, short references to licences first.
TEMPLATES = (
    Template("agpl-3.0", "GNU Affero General Public License", ("affero general public license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("gpl-2.0", "GNU General Public License, version 2", ("general public license version 2",)),
    Template("gpl-3.0", "GNU General Public License, version 3", ("general public license version 3",)),
    Template("lgpl", "GNU Lesser General Public License", ("lesser general public license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use in source and binary forms", "are permitted")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute", "is hereby granted")),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", ("permission is hereby granted", "free of charge", "obtaining a copy")),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright and related or neighboring rights",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one", ("mozilla public license",)),
    Template(
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY
        OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
        LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
        THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        ("permission is hereby granted", "free of charge", "without restriction", "as is", "without warranty"),
    ),
    Template(
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        ("is hereby granted", "disclaims all warranties"),
    ),
    Template(
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED
        BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
        ("redistribution and use", "are permitted", "redistributions of source code must retain", "redistributions in binary form must reproduce", "as is"),
    ),
    Template(
        "bsd-3-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the
        copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
        EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.""",
        ("redistribution and use", "are permitted", "redistributions of source code must retain", "endorse or promote products", "prior written permission"),
    ),
    Template(
        "apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
        ("apache license", "in compliance with the license", "governing permissions and limitations"),
    ),
    Template(
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
        ("you can redistribute it and or modify it", "general public license", "without any warranty"),
    ),
    Template(
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
        any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The
        origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source
        versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be
        removed or altered from any source distribution.""",
        ("permission is granted to anyone", "must not be misrepresented", "may not be removed or altered"),
    ),
    Template(
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
        ("free and unencumbered software",),
    ),
)

#: Words of everyday English that say nothing of a licence; all other words of the templates are licence words.
EVERYDAY = frozenset(
    """a all an and any anyone are as at be being but by can code copy even event except file files for form free from has have held if
    in including into is it its law list may means met more must name names neither no nor not obtain of on one option or original
    other out owner person persons provided required see shall so such terms that the this to under unless use used useful version
    was whether which who will with without work writing written you your""".split()
)
SLACK = 8  # words that may stand between two parts of a notice, or be left out


def licence_words(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words} - EVERYDAY)


def document_frequencies(words: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many of all documents each licence word stands; as many numbers as the templates have words."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    rows = words.select(F.explode(F.array_intersect("_words", known)).alias("w")).groupBy("w").count().collect()
    return {w: 0 for w in vocabulary} | {r["w"]: r["count"] for r in rows}


def _sql_array(rows: Sequence[str], kind: str) -> Column:
    """A literal array; one text for Spark to read, which folds it into a constant."""
    return F.expr(f"array({', '.join(rows)})") if rows else F.array().cast(f"array<{kind}>")


def _base_places(df: DataFrame, base: Sequence[Template]) -> DataFrame:
    """``_base``: every place (phrase number, start) where a phrase's words stand consecutively.

    All words of the phrases are indexed. Each of their places votes for where a phrase would begin, and a phrase stands
    where as many votes agree as it has words.
    """
    postings = _sql_array([f"named_struct('w', '{w}', 't', {n}, 'p', {i})" for n, t in enumerate(base) for i, w in enumerate(t.words)], "struct<w:string,t:int,p:int>")
    length = _sql_array([str(len(t.words)) for t in base], "int")
    words, indexed = F.col("_words"), sorted({w for t in base for w in t.words})
    hits = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(indexed), F.struct(w.alias("w"), i.alias("i")))))
    voted = F.flatten(
        F.transform("_base_hits", lambda h: F.transform(F.filter(postings, lambda p: p["w"] == h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("s"))))
    )
    like = lambda x, i: F.coalesce(F.get(F.col("_base_votes"), i) == x, F.lit(False))
    elected = F.filter("_base_votes", lambda x, i: ~like(x, i - 1) & like(x, i + F.get(length, x["t"]) - 1))
    return (
        df.withColumn("_base_hits", F.when(F.arrays_overlap(words, F.array(*[F.lit(w) for w in indexed])), hits))
        .withColumn("_base_votes", F.when(F.size("_base_hits") > 0, F.sort_array(voted)))
        .withColumn("_base", F.when(F.size("_base_votes") > 0, elected).otherwise(F.array().cast("array<struct<t:int,s:int>>")))
    )


def _notice_places(df: DataFrame, templates: Sequence[Template], rarest_first: Sequence[str], looked_up: int, votes: int) -> DataFrame:
    """``_places``: verified places (template number, start, share of the template's word pairs), from ``_words``.

    The file's ``looked_up`` licence words of highest inverse document frequency are looked up in the index; each of their
    places votes, with every posting of the word, for where that template would begin. Votes for one template that follow
    one another within the slack make a place if enough different words agree; its key phrases are then sought in order.
    """
    words = F.col("_words")
    postings = _sql_array([f"named_struct('w', '{w}', 't', {n}, 'p', {i})" for n, t in enumerate(templates) for i, w in enumerate(t.words) if w not in EVERYDAY], "struct<w:string,t:int,p:int>")
    need = _sql_array([str(min(votes, len(set(t.words) - EVERYDAY))) for t in templates], "int")
    length = _sql_array([str(len(t.words)) for t in templates], "int")
    pattern = _sql_array([f"'{key_pattern(t)}'" for t in templates], "string")
    pairs = _sql_array([f"array({', '.join(repr(p) for p in word_pairs(t))})" for t in templates], "array<string>")
    index = F.array(*[F.lit(w) for w in rarest_first])
    mine = F.slice(F.array_intersect(index, words), 1, looked_up)
    hits = F.array_compact(F.transform(words, lambda w, i: F.when(F.array_contains("_mine", w), F.struct(w.alias("w"), i.alias("i")))))
    voted = F.flatten(
        F.transform("_hits", lambda h: F.transform(F.filter(postings, lambda p: p["w"] == h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("s"), p["w"].alias("w"))))
    )
    before = lambda i: F.get(F.col("_votes"), i - 1)
    heads = F.array_compact(F.transform("_votes", lambda x, i: F.when((i == 0) | (before(i)["t"] != x["t"]) | (x["s"] - before(i)["s"] > SLACK), i)))
    until = lambda k: F.coalesce(F.get(F.col("_heads"), k + 1), F.size("_votes"))
    runs = F.transform("_heads", lambda j, k: F.slice("_votes", j + 1, until(k) - j))
    agreed = F.filter(
        F.transform(runs, lambda r: F.struct(r[0]["t"].alias("t"), r[0]["s"].alias("s"), F.get(r, F.size(r) - 1)["s"].alias("e"), F.size(F.array_distinct(F.transform(r, lambda x: x["w"]))).alias("n"))),
        lambda c: c["n"] >= F.get(need, c["t"]),
    )
    start = lambda c: F.greatest(c["s"] - SLACK, F.lit(0))
    part = lambda c: F.slice(words, start(c) + 1, c["e"] - c["s"] + F.get(length, c["t"]) + 2 * SLACK)
    looked = F.transform("_agreed", lambda c: F.struct(c["t"].alias("t"), F.greatest(c["s"], F.lit(0)).alias("s"), part(c).alias("part")))
    stands = lambda c: F.rlike(F.concat(F.lit(" "), F.array_join(c["part"], " "), F.lit(" ")), F.get(pattern, c["t"]))
    own_pairs = lambda c: F.zip_with(c["part"], F.slice(c["part"], 2, F.size(c["part"])), lambda a, b: F.concat_ws(" ", a, b))
    share = lambda c: F.size(F.array_intersect(F.get(pairs, c["t"]), own_pairs(c))) / F.size(F.get(pairs, c["t"]))
    none = F.array().cast("array<struct<t:int,s:int,share:double>>")
    return (
        df.withColumn("_mine", mine)
        .withColumn("_hits", F.when(F.size("_mine") > 0, hits))
        .withColumn("_votes", F.when(F.size("_hits") > 0, F.sort_array(voted)))
        .withColumn("_heads", F.when(F.size("_votes") > 0, heads))
        .withColumn("_agreed", F.when(F.size("_heads") > 0, agreed))
        .withColumn("_looked", F.when(F.size("_agreed") > 0, looked))
        .withColumn("_places", F.when(F.size("_looked") > 0, F.transform(F.filter("_looked", stands), lambda c: F.struct(c["t"].alias("t"), c["s"].alias("s"), share(c).alias("share")))).otherwise(none))
    )


def key_pattern(template: Template) -> str:
    """The template's key phrases in their order, with any words between them, in words that stand one blank apart."""
    return " " + "(.* )?".join(f"{phrase} " for phrase in template.phrases)


def word_pairs(template: Template) -> list[str]:
    """The distinct pairs of neighbouring words."""
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(template.words, template.words[1:])))


def scan_licenses(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text", base: Sequence[Template] = BASE_TEMPLATES, more: Sequence[Template] = TEMPLATES, looked_up: int = 12, votes: int = 2) -> DataFrame:
    """Licence labels of every document: ``doc`` (carried columns) and the columns below.

    ``n_words``; ``base_places`` (structs of label and start word) of the base phrases, wherever their words stand
    consecutively; ``places`` (label, start word, share) of the further templates; ``labels``; ``score``, the best share
    of a template's neighbouring words found at a place, 1 for a base phrase. A place begins where its earliest vote has it
    begin, which may be some words early. Words may be inserted in a notice or left
    out, ``SLACK`` at a time, but not within a key phrase.

    Two passes over the texts: one counts in how many documents the licence words stand, as many numbers as there are
    licence words, the other finds the places. Nothing but those counts is shuffled. A null or empty text has no words
    and no labels; a text of any length is scanned whole, within its row. Repeated rows are scanned alike. An empty table
    gives an empty result. Input columns travel inside ``doc``.
    """
    rows = docs.select(packed(carry).alias("doc"), split_words(ascii_lower(text_or_empty(text)), BETWEEN).alias("_words"))
    frequencies = document_frequencies(rows, licence_words(more))
    rarest_first = sorted(frequencies, key=lambda w: (frequencies[w], w))
    base_labels, labels = (F.array(*[F.lit(t.label) for t in ts]) for ts in (base, more))
    scanned = _notice_places(_base_places(rows, base), more, rarest_first, looked_up, votes).select(
        "doc",
        F.size("_words").cast("long").alias("n_words"),
        F.transform("_base", lambda x: F.struct(F.get(base_labels, x["t"]).alias("label"), x["s"].cast("long").alias("start"))).alias("base_places"),
        F.transform("_places", lambda x: F.struct(F.get(labels, x["t"]).alias("label"), x["s"].cast("long").alias("start"), x["share"].alias("share"))).alias("places"),
    )
    every = F.concat(F.transform("base_places", lambda x: x["label"]), F.transform("places", lambda x: x["label"]))
    best = F.greatest(F.when(F.size("base_places") > 0, 1.0), F.array_max(F.transform("places", lambda x: x["share"])), F.lit(0.0))
    return scanned.withColumn("labels", F.array_sort(F.array_distinct(every))).withColumn("score", best)
