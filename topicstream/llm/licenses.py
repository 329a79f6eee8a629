"""Licence scans by a positional index of rare words.

The templates are notices and whole licence texts. A word's inverse document frequency is that over the templates; the
index holds, for every word with a high one, where it stands in which template. Those of them that a text holds
vote for (template, shift) pairs; pairs with enough votes at one shift are templates that may stand there, and are verified
by the key phrases that the template must have in place. All of it happens within the row, so nothing is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicstream.llm.common import let, lower_ascii, text_or_empty

#: Fixed values of the contract: what separates words, and the base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices of public licences, with the label and the phrases that must stand in their place.
NOTICES = (
    ("mit", "released under the mit license", ("the mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ("hereby granted free of charge", "associated documentation files"),
    ),
    ("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        ("free software you can redistribute it", "gnu general public license"),
    ),
    ("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("source and binary forms", "with or without modification"),
    ),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
)
#: Texts of public licences, from the sentence on that all copies have, with label and key phrases.
TEXTS = (
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        ("to deal in the software without restriction", "merge publish distribute sublicense and or sell copies"),
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
        ("for any purpose with or without fee", "permission notice appear in all copies"),
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
        PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
        GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
        OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
        ("redistributions of source code must retain", "redistributions in binary form must reproduce"),
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being
        the original software. 3. This notice may not be removed or altered from any source distribution.""",
        ("must not be misrepresented you must not claim", "altered source versions must be plainly marked"),
    ),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
        ("required by applicable law or agreed to in writing", "specific language governing permissions and limitations"),
    ),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program.""",
        ("published by the free software foundation either version", "in the hope that it will be useful"),
    ),
    (
        "mpl",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        ("source code form is subject to the terms", "copy of the mpl was not distributed with this file"),
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
        ("free and unencumbered software", "source code form or as a compiled binary"),
    ),
    (
        "boost",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
        and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
        Software is furnished to do so.""",
        ("accompanying documentation covered by this license", "prepare derivative works of the software"),
    ),
)
NOTICES = (*NOTICES, *((label, " ".join(re.findall(WORD, text.lower())), phrases) for label, text, phrases in TEXTS))
RARE = 3  # words whose inverse document frequency is at least that of one in so many templates are indexed
VOTES = 2  # such words that must agree on a shift; fewer if the template's key phrases hold fewer


def words_of(text: str) -> list[str]:
    return re.findall(WORD, text)


def index() -> tuple[dict[str, list[tuple[int, int]]], list[int]]:
    """Postings (notice, place) of each rare word, and the votes each notice needs."""
    split = [words_of(text) for _, text, _ in NOTICES]
    shared = Counter(word for words in split for word in set(words))
    frequency = {word: math.log(len(NOTICES) / n) for word, n in shared.items()}
    postings: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for notice, words in enumerate(split):
        for at, word in enumerate(words):
            if frequency[word] >= math.log(len(NOTICES) / RARE):
                postings[word].append((notice, at))
    # Key phrases are looked at anyway, so where they stand their rare words must do; without any, one of the notice's must.
    held = [sum(word in postings for _, words in keys for word in words) for keys in key_phrases()]
    return dict(postings), [min(VOTES, max(1, n)) for n in held]


def key_phrases() -> list[list[tuple[int, list[str]]]]:
    """For each notice the places and words of its key phrases."""
    found = []
    for _, text, phrases in NOTICES:
        words = words_of(text)
        keys = [words_of(phrase) for phrase in phrases]
        found.append([(next(i for i in range(len(words)) if words[i : i + len(k)] == k), k) for k in keys])
    return found


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices) for every row.

    Base phrases count wherever their words stand consecutively; first_word and last_word are the smallest and largest
    start of one, null without any. ``notices`` holds the verified notices as (label, start, share of the notice's words
    in place), ``labels`` the labels of both, and ``score`` is 1 with a base phrase, else the largest such share, else 0.
    Null and empty texts have no words and no labels (empty strings). Rows are scanned one by one, so repeated rows,
    null ids and empty tables need no rule; other columns are ignored.
    """
    words = F.regexp_extract_all(lower_ascii(text_or_empty(text_col)), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words.alias("w"))
    rows = rows.select("doc_id", "w", _base().alias("base"), _candidates().alias("candidates"))
    rows = rows.select("doc_id", F.size("w").cast("long").alias("n_words"), "base", _verified().alias("found"))
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    labels = F.array_sort(F.array_union(base_labels, F.transform("found", lambda x: x["label"])))
    starts = F.transform("base", lambda x: x["start"])
    shares = F.array_max(F.transform("found", lambda x: x["share"]))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(shares, F.lit(0.0))).alias("score"),
        F.col("found").alias("notices"),
    )


def _places(words: Column) -> Column:
    """0 to the number of words less one; nothing for no words."""
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))


def _stands(phrase: list[str], at: Column) -> Column:
    """True where the words of the phrase stand from ``at`` on."""
    # The first word alone decides at most places.
    stretch = F.slice("w", F.greatest(at, F.lit(0)) + 1, len(phrase))
    return F.coalesce((F.get("w", at) == phrase[0]) & (stretch == F.split(F.lit(" ".join(phrase)), " ")), F.lit(False))


def _base() -> Column:
    return F.concat(*[_base_places(words_of(phrase), label) for phrase, label in BASE])


def _base_places(phrase: list[str], label: str) -> Column:
    places = F.filter(_places(F.col("w")), lambda i: _stands(phrase, i))
    found = F.transform(places, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))
    nothing = F.array().cast("array<struct<start:int,label:string>>")
    return F.when(F.array_contains("w", phrase[0]), found).otherwise(nothing)


def _candidates() -> Column:
    """Distinct (notice, shift) pairs on which enough rare words agree."""
    postings, votes = index()
    listed = {word: [{"n": n, "p": p} for n, p in places] for word, places in postings.items()}
    of_word = F.from_json(F.lit(json.dumps(listed)), "map<string, array<struct<n: int, p: int>>>")
    # As SQL text: a list of so many literals takes seconds to build one by one.
    words = ", ".join(f"'{word}'" for word in postings)
    places = F.expr(f"filter(if(size(w) > 0, sequence(0, size(w) - 1), array()), i -> get(w, i) IN ({words}))")
    votes_of = F.array(*[F.lit(v) for v in votes])
    pairs = F.flatten(
        F.transform(
            places,
            lambda i: F.transform(
                of_word[F.get("w", i)], lambda q: F.struct(q["n"].alias("n"), (i - q["p"]).alias("shift"))
            ),
        )
    )
    # In order, a pair that occurs v times is the same as the pair v - 1 places on.
    agreed = let(
        F.array_sort(pairs),
        lambda ordered: F.filter(ordered, lambda pair, i: F.get(ordered, i + F.get(votes_of, pair["n"]) - 1) == pair),
    )
    return F.when(F.size(places) > 0, F.array_distinct(agreed)).otherwise(
        F.array().cast("array<struct<n:int,shift:int>>")
    )


def _verified() -> Column:
    keys = key_phrases()
    found = [_in_place(n, label, words_of(text), keys[n]) for n, (label, text, _) in enumerate(NOTICES)]
    nothing = F.array().cast("array<struct<label:string,start:int,share:double>>")
    return F.when(F.size("candidates") > 0, F.concat(*found)).otherwise(nothing)


def _in_place(number: int, label: str, notice: list[str], keys: list[tuple[int, list[str]]]) -> Column:
    """The candidates of one notice whose key phrases stand in their places, with the share of its words that do."""

    def holds(c: Column) -> Column:
        held = c["n"] == number
        for at, words in keys:
            held = held & _stands(words, c["shift"] + at)
        return held

    words = F.split(F.lit(" ".join(notice)), " ")

    def described(c: Column) -> Column:
        # Of a shift before the text's beginning the places below 0 hold no words.
        pairs = F.filter(F.sequence(F.lit(0), F.lit(len(notice) - 1)), lambda i: F.get("w", c["shift"] + i) == F.get(words, i))
        return F.struct(F.lit(label).alias("label"), c["shift"].alias("start"), (F.size(pairs) / len(notice)).alias("share"))

    return F.transform(F.filter("candidates", holds), described)
