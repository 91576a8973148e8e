"""License scan by patience alignment of texts with license templates.

A template word that occurs once in the template and is not a common word opens a window of text where it
occurs. Within the window, words that are unique on both sides are anchors; the longest
run of anchors in the same order on both sides is kept, and the gaps between them are
aligned in the same way. Equal words next to an anchor, and at the ends of a gap, are
aligned with it. Coverage is the aligned share of the template's words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.blocks import blocks

#: Share of a template's words that must be aligned, and of the words of the matched span.
MIN_COVERAGE, MIN_DENSITY = 0.8, 0.6

# fixed values: notices by which texts name their license
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: Redistributions of source code must retain the "
        "above copyright notice, this list of conditions and the following disclaimer."
    ),
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
}
# fixed values: words too common to open a window
COMMON = frozenset(
    b"a above and any are as at by in is it may not of on or the this to under use with you 0 2 3 4".split()
)
# fixed values: words that tell one license from another, besides version numbers
TELLING = frozenset(b"lesser affero nc nd sa noncommercial noderivatives noderivs sharealike".split())
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def tokens(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _tells(words: list[bytes], i: int) -> bool:
    """Whether a word that a template does not have makes the text another license."""
    before = words[i - 1] if i else b""
    return (
        words[i] in TELLING
        or (words[i] == b"library" and before == b"gnu")
        or (words[i].isdigit() and before in (b"version", b"v"))
    )


def _in_order(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, sorted by the first number, in which the second rises."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tails, b)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(b)
            at.append(i)
        else:
            tails[k], at[k] = b, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places of two word lists, rising on both sides.

    Equal words at the ends of a gap count only next to an anchor: at the ends of the
    lists a stray word would stretch the match.
    """
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b), False, False)]
    while gaps:
        a0, a1, b0, b1, after, before = gaps.pop()
        while after and a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while before and a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        one = {w for w, n in Counter(a[a0:a1]).items() if n == 1}
        one &= {w for w, n in Counter(b[b0:b1]).items() if n == 1}
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if w in one}
        anchors = _in_order([(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in one])
        out += anchors
        for i, j in anchors:
            gaps.append((a0, i, b0, j, after, True))
            a0, b0, after = i + 1, j + 1, True
        if anchors:
            gaps.append((a0, a1, b0, b1, True, before))
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str):
        self.name, self.words = name, tokens(text.encode())
        counts = Counter(self.words)
        #: place of every word that may open a window
        self.opens = {
            w: i for i, w in enumerate(self.words) if counts[w] == 1 and w not in COMMON
        }
        #: words that a match must have at one of their places at least
        self.telling = {w for w in self.words if w in TELLING or w.isdigit()}

    def scan(self, words: list[bytes], hits: list[int]) -> Iterator[dict]:
        """Matches in a text; *hits* are the places of words that open windows of this template."""
        slack, end = len(self.words) // 2 + 3, 0
        again = {}
        for p in hits:
            again.setdefault(words[p], []).append(p)
        for p in hits:
            if p < end:
                continue
            place = self.opens[words[p]]
            first = max(end, p - place - slack)
            last = min(len(words), p + len(self.words) - place + slack)
            own = again[words[p]]
            following = bisect_left(own, p + 1)
            if following < len(own):  # another copy begins there, less what precedes the word in it
                last = min(last, max(p + 1, own[following] - place))
            found = align(words[first:last], self.words)
            if not found:
                continue
            low, high = found[0][0] + first, found[-1][0] + first + 1
            coverage, density = len(found) / len(self.words), len(found) / (high - low)
            if coverage >= MIN_COVERAGE and density >= MIN_DENSITY and self._is_own(words, found, first, low, high):
                end = high
                yield {"license": self.name, "coverage": coverage, "first": low, "end": high}

    def _is_own(self, words: list[bytes], found: list[tuple[int, int]], first: int, low: int, high: int) -> bool:
        """Whether all telling words of the template are aligned and no other one is between them."""
        aligned = {a + first for a, _ in found}
        if not self.telling <= {self.words[b] for _, b in found}:
            return False
        return not any(i not in aligned and _tells(words, i) for i in range(low, high))


def with_licenses(df: DataFrame, text: str, name: str, templates: dict[str, str] | None = None) -> DataFrame:
    """Adds all matches of a text, by place: ``(license, coverage, first, end)`` in word numbers.

    Words are runs of digits, letters and characters above ASCII, in lower case. All of a text is scanned;
    a NULL or empty text has no matches. Where templates overlap each gives its own
    match: a notice within a longer license text is reported beside it.
    """
    known = [Template(k, v) for k, v in (templates or TEMPLATES).items()]
    opening = frozenset(w for t in known for w in t.opens)
    kind = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("end", pa.int64())])

    def matches(raw: bytes) -> list[dict]:
        words = tokens(raw)
        hits = [i for i, w in enumerate(words) if w in opening]
        out = []
        for t in known if hits else ():
            own = [i for i in hits if words[i] in t.opens]
            if own:
                out += t.scan(words, own)
        return sorted(out, key=lambda x: (x["first"], -x["end"], x["license"]))

    @F.arrow_udf("array<struct<license:string,coverage:double,first:bigint,end:bigint>>")
    def scanned(texts: pa.Array) -> pa.Array:
        found = []
        for _, offsets, data in blocks(texts):
            raw = data.tobytes()
            found += [matches(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return pa.array(found, pa.list_(kind))

    return df.withColumn(name, scanned(F.col(text)))


def license_scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """``(key, license, coverage, n_matches, matches)``, a row for each row of *df*.

    ``license`` is the template with the greatest coverage, then the longest match, then
    the first name; NULL with coverage 0 where nothing matches. ``matches`` lists all as
    ``license:first:end``.
    """
    marked = with_licenses(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", "found", templates)
    best = F.array_max(
        F.transform(
            "found",
            lambda x: F.struct(x["coverage"].alias("coverage"), (x["end"] - x["first"]).alias("size"), x["license"].alias("license")),
        )
    )
    listed = F.transform("found", lambda x: F.concat_ws(":", x["license"], x["first"], x["end"]))
    return marked.select("key", "found").select(
        F.col("key").alias(key),
        best["license"].alias("license"),
        F.coalesce(best["coverage"], F.lit(0.0)).alias("coverage"),
        F.size("found").cast("bigint").alias("n_matches"),
        F.array_join(listed, ",").alias("matches"),
    )
