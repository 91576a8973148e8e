"""Benchmark decontamination with a distributed positional inverted index.

The index is dealt by document: each row of the index table is a shard, which holds
for a few MB of text every term and the positions of every one of its occurrences. A
shard is built and searched in one task; nothing is shuffled, and a term that occurs in
every document is spread over all shards. The table is stored in the shared folder.

A phrase is looked up from its rarest term of the shard: that term's positions, less
its place in the phrase, are the candidates, and they are intersected with the equally
adjusted positions of the other terms, rarest first. All phrases of a block are looked
up together. A proximity search starts from the same list and keeps a position if each
of the other terms has a position near it.

Terms are told apart by 64-bit hashes. Items are searched in blocks of at most
``ITEM_BYTES`` of text, so what the tasks receive stays small however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.blocks import ALNUM_WORDS, blocks, words
from martflow.sources.workdir import store

WINDOW_WORDS = 10
ITEM_BYTES = 4 << 20
INDEX_SCHEMA = (
    "shard bigint, keys array<bigint>, n_words array<int>, "
    "terms binary, counts binary, postings binary"
)
MATCH_SCHEMA = "shard bigint, row int, item int, first array<int>, end array<int>"
_SHIFT = np.uint64(32)


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as bytes of seven bits each, the lowest first."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >= np.uint64(1 << (7 * k)) if 7 * k < 64 else 0
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - sizes
    for k in range(int(sizes.max(initial=0))):
        has = sizes > k
        part = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[has] + k] = part | ((sizes[has] > k + 1).astype(np.uint64) << np.uint64(7))
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    """The integers that :func:`pack` has written."""
    cells = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(cells < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    out, sizes = np.zeros(len(ends), np.uint64), ends - starts + 1
    for k in range(int(sizes.max(initial=0))):
        has = sizes > k
        part = (cells[starts[has] + k] & np.uint8(127)).astype(np.uint64)
        out[has] |= part << np.uint64(7 * k)
    return out.astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        keys = batch.column(0)
        for first, offsets, data in blocks(batch.column(1)):
            starts, _, hashes = words(data, offsets, ALNUM_WORDS)
            at = np.searchsorted(starts, offsets)
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            new = np.ones(len(ordered), bool)
            new[1:] = ordered[1:] != ordered[:-1]
            begin = np.flatnonzero(new)
            steps = np.diff(order, prepend=0)
            steps[begin] = order[begin]
            row = {
                "shard": [number],
                "keys": [keys.slice(first, len(offsets) - 1).to_pylist()],
                "n_words": [np.diff(at)],
                "terms": [ordered[begin].tobytes()],
                "counts": [pack(np.diff(np.append(begin, len(ordered))))],
                "postings": [pack(steps)],
            }
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row.values(), types, strict=True)], list(row)
            )
            number += 1


def build_index(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all rows and whole texts of *df*, a row for each shard."""
    plain = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return store(plain.mapInArrow(_shards, INDEX_SCHEMA), "index")


@dataclass(frozen=True)
class Phrases:
    """Phrases of a block of items: their terms, one after the other, and their items."""

    terms: np.ndarray
    at: np.ndarray
    item: np.ndarray


def item_phrases(texts: list[str | None], window: int) -> Phrases:
    """All windows of the texts; a text of fewer words, but not none, is one window."""
    parts, sizes, items = [], [], []
    for i, text in enumerate(texts):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        own = words(raw, np.array([0, len(raw)]), ALNUM_WORDS)[2]
        if not len(own):
            continue
        size = min(window, len(own))
        windows = np.lib.stride_tricks.sliding_window_view(own, size)
        parts.append(windows.ravel())
        sizes += [size] * len(windows)
        items += [i] * len(windows)
    terms = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return Phrases(terms, np.concatenate([[0], np.cumsum(sizes)]).astype(int), np.array(items, int))


class _Shard:
    """One shard, reduced to the terms that are asked for."""

    def __init__(self, row: dict, wanted: np.ndarray):
        self.number, self.keys = row["shard"], row["keys"]
        self.at = np.concatenate([[0], np.cumsum(row["n_words"])]).astype(np.int64)
        terms = np.frombuffer(row["terms"], np.uint64)
        counts = unpack(row["counts"])
        ends = np.cumsum(counts)
        found = np.minimum(np.searchsorted(terms, wanted), max(0, len(terms) - 1))
        has = terms[found] == wanted if len(terms) else np.zeros(len(wanted), bool)
        #: occurrences of each wanted term, and where its positions begin
        self.count = np.where(has, counts[found], 0) if len(terms) else np.zeros(len(wanted), int)
        steps = unpack(row["postings"])
        sums = np.concatenate([[0], np.cumsum(steps)])
        begin = np.where(has, ends[found] - counts[found], 0) if len(terms) else self.count
        self.begin = np.concatenate([[0], np.cumsum(self.count)])
        place = np.repeat(begin - self.begin[:-1], self.count) + np.arange(self.begin[-1])
        self.positions = sums[place + 1] - np.repeat(sums[begin], self.count)
        # (term, position) as one sorted number, for looking up many at once
        owner = np.repeat(np.arange(len(wanted)), self.count).astype(np.uint64)
        self.sorted = (owner << _SHIFT) | self.positions.astype(np.uint64)

    def has(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the term has a position from low to high."""
        key = term.astype(np.uint64) << _SHIFT
        i = np.searchsorted(self.sorted, key | np.maximum(low, 0).astype(np.uint64))
        inside = i < len(self.sorted)
        inside[inside] = self.sorted[i[inside]] <= (key | high.astype(np.uint64))[inside]
        return inside & (high >= 0)


def _candidates(shard: _Shard, phrases: Phrases, term: np.ndarray):
    """Phrases all of whose terms occur, their places by rarity, and the rarest term's positions."""
    sizes = np.diff(phrases.at)
    count = shard.count[term]
    live = np.flatnonzero(np.minimum.reduceat(count, phrases.at[:-1]) > 0)
    longest = int(sizes[live].max(initial=0))
    place = np.arange(longest)[None, :]
    inside = place < sizes[live][:, None]
    cell = np.where(inside, phrases.at[live][:, None] + place, 0)
    rarity = np.where(inside, count[cell], np.iinfo(np.int64).max)
    order = np.argsort(rarity, axis=1, kind="stable")
    rare = term[phrases.at[live] + order[:, 0]] if len(live) else live
    many = shard.count[rare]
    phrase = np.repeat(np.arange(len(live)), many)
    first = np.cumsum(many) - many
    position = shard.positions[
        np.repeat(shard.begin[rare] - first, many) + np.arange(int(many.sum()))
    ]
    return live, sizes[live], order, phrase, position


def _exact(shard: _Shard, phrases: Phrases, term: np.ndarray):
    live, sizes, order, phrase, position = _candidates(shard, phrases, term)
    start = position - order[phrase, 0] if len(live) else position
    for k in range(1, order.shape[1]):
        open_ = k < sizes[phrase]
        place = order[phrase, k]
        cell = np.where(open_, phrases.at[live[phrase]] + place, 0)
        at = start + place
        kept = ~open_ | shard.has(term[cell], at, at)
        phrase, start = phrase[kept], start[kept]
    end = start + sizes[phrase]
    # a phrase lies in one document
    row = np.searchsorted(shard.at, start, "right") - 1
    kept = (start >= 0) & (end <= shard.at[np.minimum(row + 1, len(shard.at) - 1)])
    return live[phrase[kept]], row[kept], start[kept], end[kept]


def _near(shard: _Shard, phrases: Phrases, term: np.ndarray, slop: int):
    live, sizes, order, phrase, position = _candidates(shard, phrases, term)
    row = np.searchsorted(shard.at, position, "right") - 1
    for k in range(1, order.shape[1]):
        open_ = k < sizes[phrase]
        cell = np.where(open_, phrases.at[live[phrase]] + order[phrase, k], 0)
        low = np.maximum(position - slop, shard.at[row])
        high = np.minimum(position + slop, shard.at[row + 1] - 1)
        kept = ~open_ | shard.has(term[cell], low, high)
        phrase, position, row = phrase[kept], position[kept], row[kept]
    return live[phrase], row, position, position + 1


def _merged(group: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Unions of the spans of each group: group, first, end."""
    order = np.lexsort((start, group))
    group, start, end = group[order], start[order], end[order]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    # the furthest end so far within the group, by a maximum over (group, end)
    wide = int(end.max(initial=0)) + 1
    number = np.cumsum(new)
    reach = np.maximum.accumulate(number * wide + end) - number * wide
    apart = new.copy()
    apart[1:] |= start[1:] > reach[:-1]
    begin = np.flatnonzero(apart)
    last = (np.append(begin[1:], len(group)) - 1)[: len(begin)]
    return group[begin], start[begin], reach[last]


def _search(index: DataFrame, phrases: Phrases, slop: int | None) -> DataFrame:
    wanted, term = np.unique(phrases.terms, return_inverse=True)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
                shard = _Shard(row, wanted)
                if slop is None:
                    phrase, doc, start, end = _exact(shard, phrases, term)
                else:
                    phrase, doc, start, end = _near(shard, phrases, term, slop)
                many = len(phrases.item) + 1
                group = doc * many + phrases.item[phrase]
                group, start, end = _merged(group, start, end)
                doc, item = group // many, group % many
                start, end = start - shard.at[doc], end - shard.at[doc]
                cut = np.flatnonzero(np.diff(group, prepend=-1))
                at = pa.array(np.append(cut, len(group)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(cut), shard.number)),
                        pa.array(doc[cut], pa.int32()),
                        pa.array(item[cut], pa.int32()),
                        pa.ListArray.from_arrays(at, pa.array(start, pa.int32())),
                        pa.ListArray.from_arrays(at, pa.array(end, pa.int32())),
                    ],
                    ["shard", "row", "item", "first", "end"],
                )

    if not len(phrases.item):
        return index.sparkSession.createDataFrame([], MATCH_SCHEMA)
    return index.mapInArrow(found, MATCH_SCHEMA)


def matches(
    index: DataFrame,
    items: DataFrame,
    key: str = "item_id",
    text: str = "text",
    window: int = WINDOW_WORDS,
    slop: int | None = None,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """``(shard, row, item_id, first, end)``: the words of a document that an item's windows hit.

    ``first`` and ``end`` are the merged spans of word numbers in the document, end
    exclusive. Without *slop* they cover exact occurrences of a window. With it they are the
    positions of a window's rarest word that have all other words of the window
    within *slop* words, in any order. Items without words match nothing; equal items
    match alike, each with its own row. Items with a NULL key are named NULL.
    """
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint")
    plain = items.select(F.col(key).cast("string").alias("item_id"), F.col(text).alias("text"), size.alias("size"))
    total = plain.agg(F.sum("size")).first()[0] or 0
    parts = 1 + int(2 * total // item_bytes)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    out = None
    for part in range(parts):
        # one block of about item_bytes / 2
        rows = plain.filter(number == part).select("item_id", "text").collect()
        rows.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or "", r["text"] or ""))
        found = _search(index, item_phrases([r["text"] for r in rows], window), slop)
        names = index.sparkSession.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id string"
        )
        # as many names as the block has items
        named = found.join(F.broadcast(names), "item").drop("item")
        out = named if out is None else out.unionByName(named)
    return out


def contamination(
    df: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
) -> DataFrame:
    """``(key, n_words, n_hit, items, contaminated)``, a row for each row of *df*.

    ``n_hit`` counts the words inside any occurrence of an item's window, ``items``
    lists the items whose windows occur, sorted, each key once. NULL and empty texts
    have no words. Rows are kept apart by their place in the index, so repeated rows
    and NULL keys each give their own row.
    """
    index = build_index(df, key, text)
    found = matches(index, items, item_key, item_text, window)
    hit = found.groupBy("shard", "row").agg(
        F.array_sort(F.array_compact(F.collect_set("item_id"))).alias("items"),
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip("first", "end")))).alias("spans"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["end"] - F.greatest(x["first"], acc["end"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], x["end"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    hit = hit.select("shard", "row", "items", covered.alias("n_hit"))
    rows = index.select("shard", F.posexplode(F.arrays_zip("keys", "n_words")).alias("row", "x"))
    return (
        rows.select("shard", "row", F.col("x.keys").alias(key), F.col("x.n_words").cast("bigint").alias("n_words"))
        .join(hit, ["shard", "row"], "left")
        .select(
            key,
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )
