"""Licence scans: a positional index of rare licence words, in DataFrame expressions."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshfeed.llm.arrow_text import fresh, without

#: Words of a template that the index keeps, its rarest. All words of a file are looked up.
INDEX_WORDS = 6
#: The least share of a template's indexed words that must stand at one relative position, and words.
LEAST_SHARE, LEAST_WORDS = 0.5, 2

ADDED = ("n_words", "base_places", "license_matches")


@dataclass(frozen=True)
class Template:
    """A licence notice; each key phrase must stand where the notice has it."""

    label: str
    text: str
    keys: tuple[str, ...]


# fixed values: phrases that are labelled wherever they stand
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# fixed values: labels and licence tags
SPDX = (
    ("apache-2.0", "Apache-2.0"), ("mit", "MIT"), ("gpl", "GPL-2.0"), ("gpl", "GPL-3.0"), ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"),
    ("agpl", "AGPL-3.0"), ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"), ("isc", "ISC"), ("mpl-2.0", "MPL-2.0"),
    ("epl-2.0", "EPL-2.0"), ("cc0", "CC0-1.0"), ("unlicense", "Unlicense"), ("cc-by", "CC-BY-4.0"),
    ("cc-by-nc", "CC-BY-NC-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"),
)
# fixed values: whole licence texts
MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
# fixed values: licence notices
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license",)),
    Template("apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", ("apache license version 2 0",)),
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template("mit", "licensed under the MIT license", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy", ("permission is hereby granted free of charge",)),
    Template("gpl", "This work is licensed under the GNU General Public License", ("general public license",)),
    Template("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify",)),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("epl-2.0", "available under the terms of the Eclipse Public License 2.0", ("eclipse public license",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4",)),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4",)),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("creative commons attribution sharealike",)),
    Template("cc0", "dedicated to the public domain under CC0 1.0 Universal", ("cc0 1 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("reserved", "Copyright. All rights reserved.", ("all rights reserved",)),
    Template("mit", MIT_TEXT, ("permission is hereby granted free of charge", "without warranty of any kind")),
    Template("bsd", BSD_TEXT, ("redistribution and use in source and binary forms", "neither the name of")),
    Template("isc", ISC_TEXT, ("permission to use copy modify", "the author disclaims all warranties")),
    *[Template(label, f"SPDX-License-Identifier: {tag}", (f"spdx license identifier {tag.lower().replace('-', ' ').replace('.', ' ')}",)) for label, tag in SPDX],
)

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def words(text: str) -> Column:
    """Words of a text: A-Z lower-cased, runs of letters, digits and characters beyond ASCII; null: none."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(_WORD), 0)


_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(text: Column) -> Column:
    """The words, and an empty string where the text begins or ends with no word's character."""
    return F.split(F.coalesce(text, F.lit("")), _BREAK, -1)


def _count_words(text: str) -> Column:
    parts = _split(F.col(text))
    ends = (F.get(parts, F.lit(0)) == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    return F.greatest(F.size(parts) - ends, F.lit(0)).cast("long")


def _list(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


@dataclass(frozen=True)
class Index:
    """Templates, the rarest words of each with their positions, and the words' inverse frequencies."""

    templates: tuple[Template, ...]
    postings: tuple[tuple[tuple[str, int], ...], ...]
    idf: dict[str, float]

    def anchors(self) -> list[str]:
        """Of each phrase that anything is labelled by the longest word; of those the one in most phrases,
        then the rarest. A text without any of them as a part can have no label."""
        phrases = [p.split(" ") for p, _ in PHRASES] + [k.split(" ") for t in self.templates for k in t.keys]
        shared = {w: sum(w in p for p in phrases) for p in phrases for w in p}
        return sorted({max(p, key=lambda w: (len(w), shared[w], self.idf.get(w, 0.0), w)) for p in phrases})


def build_index(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> Index:
    """Counts over all documents in how many each word of the templates occurs, and keeps the positions
    of each template's ``INDEX_WORDS`` rarest words, the three rarest and those with at least half of the
    rarest one's inverse frequency. Words that no document has are the rarest, so an index also serves
    other documents than those it was counted on; of equally rare words the longest are taken.

    One count for each template word goes to the driver, however many documents there are; null
    texts count as documents without words.
    """
    known = sorted({w for t in templates for w in _words_of(t.text)})
    counted = docs.select(F.array_intersect(_split(F.lower(text)), _list(known)).alias("found"))
    total = docs.count()
    frequency = dict(counted.select(F.explode_outer("found").alias("word")).groupBy("word").count().collect())
    idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 1)) for w in known}
    postings = []
    for t in templates:
        own = _words_of(t.text)
        rare = sorted(set(own), key=lambda w: (-idf[w], -len(w), own.index(w)))[:INDEX_WORDS]
        # beside its three rarest no common words: those would be looked up at every turn
        rare = rare[:3] + [w for w in rare[3:] if idf[w] >= idf[rare[0]] / 2]
        postings.append(tuple((w, k) for k, w in enumerate(own) if w in rare))
    return Index(templates, tuple(postings), idf)


def _places(words_: Column, phrase: str, label: str) -> Column:
    """Where a phrase's words stand one after the other."""
    own = phrase.split(" ")
    empty = F.array().cast("array<int>")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(words_) - len(own)),
        lambda i: _at(words_, i, own),
    )
    possible = F.size(words_) >= len(own)
    for w in own:
        possible = possible & F.array_contains(words_, w)
    found = F.when(possible, starts).otherwise(empty)
    return F.transform(found, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))


def _at(words_: Column, i: Column, own: list[str]) -> Column:
    condition = F.get(words_, i) == own[0]
    for k, w in enumerate(own[1:], 1):
        condition = condition & (F.get(words_, i + k) == w)
    return F.coalesce(condition, F.lit(False))


def _votes(words_: Column, index: Index) -> Column:
    """A template, an offset and a word for each posting that one of the file's words meets; no two are equal."""
    known = sorted({w for p in index.postings for w, _ in p})
    none = F.array().cast("array<struct<t:int,at:int,k:int>>")
    if not known:
        return none
    hits = F.filter(
        F.transform(words_, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: h["w"].isin(known)
    )
    by_word = {
        w: [(t, k) for t, p in enumerate(index.postings) for x, k in p if x == w] for w in known
    }
    table = F.array(
        *[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for t, k in by_word[w]]) for w in known]
    )
    votes = F.flatten(
        F.transform(
            hits,
            lambda h: F.transform(
                F.get(table, (F.array_position(_list(known), h["w"]) - 1).cast("int")),
                lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["k"]).alias("at"), p["k"].alias("k")),
            ),
        )
    )
    return F.when(F.arrays_overlap(words_, _list(known)), F.array_sort(votes)).otherwise(none)


def _aligned(votes: Column, index: Index) -> Column:
    """Templates and offsets with enough votes. Votes are sorted, so those that agree stand together."""
    sizes = F.array(*[F.lit(len(p)) for p in index.postings])
    shape = "array<struct<t:int,at:int,share:double>>"
    first = F.struct(
        F.lit(-1).alias("t"), F.lit(0).alias("at"), F.lit(0).alias("n"), F.array().cast(shape).alias("out")
    )

    def closed(done: Column) -> Column:
        size = F.get(sizes, done["t"])
        enough = (done["n"] >= LEAST_WORDS) & (done["n"] >= LEAST_SHARE * size)
        item = F.struct(done["t"].alias("t"), done["at"].alias("at"), (done["n"] / size).alias("share"))
        return F.when(enough, F.concat(done["out"], F.array(item))).otherwise(done["out"])

    def step(done: Column, v: Column) -> Column:
        same = (done["t"] == v["t"]) & (done["at"] == v["at"])
        more = F.struct(done["t"].alias("t"), done["at"].alias("at"), (done["n"] + 1).alias("n"), done["out"].alias("out"))
        new = F.struct(v["t"].alias("t"), v["at"].alias("at"), F.lit(1).alias("n"), closed(done).alias("out"))
        return F.when(same, more).otherwise(new)

    return F.aggregate(votes, first, step, closed)


def _verified(words_: Column, aligned: Column, index: Index) -> Column:
    """Alignments whose template's key phrases all stand at their places."""
    keys = []
    for t in index.templates:
        own = _words_of(t.text)
        parts = []
        for key in t.keys:
            phrase = key.split(" ")
            at = next(k for k in range(len(own)) if own[k : k + len(phrase)] == phrase)
            parts.append(F.struct(F.lit(at).alias("k"), _list(phrase).alias("words")))
        keys.append(F.array(*parts))
    table = F.array(*keys)
    labels = _list([t.label for t in index.templates])

    def stands(a: Column) -> Column:
        def one(key: Column) -> Column:
            start = a["at"] + key["k"]
            return (start >= 0) & (F.slice(words_, F.greatest(start, F.lit(0)) + 1, F.size(key["words"])) == key["words"])

        return F.forall(F.get(table, a["t"]), one)

    return F.transform(
        F.filter(aligned, stands),
        lambda a: F.struct(F.get(labels, a["t"]).alias("label"), a["at"].cast("long").alias("start"), a["share"].alias("share")),
    )


def scan(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``; ``base_places``, start (words from 0) and label of every phrase of ``PHRASES``;
    and ``license_matches``, label, start and share of each template found.

    All indexed words of a file vote with all their places for a template and a relative position; a
    template needs half of its indexed words at one position, and its key phrases in their places.
    Texts without any of the index's anchors, which every label needs, are only counted.
    Expressions over the row alone: no shuffle, no Python. A null or empty text has no words.
    Columns of the added names are replaced.
    """
    docs = without(docs, *ADDED)
    lower, own, votes, aligned = (fresh(docs, f"license_{n}") for n in ("lower", "words", "votes", "aligned"))
    w = F.col(own)
    found = docs.withColumn("n_words", _count_words(text)).withColumn(lower, F.lower(text))
    possible = reduce(lambda a, b: a | b, [F.col(lower).contains(a) for a in index.anchors()])
    none = F.array().cast("array<string>")
    found = found.withColumn(own, F.when(possible, words(text)).otherwise(none)).drop(lower)
    found = found.withColumns(
        {
            "base_places": F.array_sort(F.concat(*[_places(w, p, label) for p, label in PHRASES])),
            votes: _votes(w, index),
        }
    )
    found = found.withColumn(aligned, _aligned(F.col(votes), index))
    return found.withColumn("license_matches", _verified(w, F.col(aligned), index)).drop(own, votes, aligned)


def joined(labels: Column) -> Column:
    """Distinct labels, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
