"""Ranked lexical search: the best documents of every query item, by grouping on presence masks.

Documents are dealt into segments, each an inverted index over the terms of the items: positions of
the documents that hold a term, its occurrences, and the sizes of all documents. The index is a
stored table, a row per segment, so a lost executor costs its own segments only. Counts over all
documents (``N``, ``L`` and how many documents hold a term) are sums over the segments.

A segment answers an item by bitmaps. The bitmaps of the item's terms, laid side by side and turned,
give each document the mask of the terms that it holds; documents with one mask form a group. A
mask's maximum score adds, over its terms, the term's weight times the greatest part that any
document of the segment has of it. Groups are scored exactly by descending maximum until the next one
lies below the item's tenth score so far; that score is carried from segment to segment of a task.
What leaves a task is at most ten documents per item.

Items are taken in blocks of BLOCK_TERMS terms, which bounds what the driver holds and sends; each
block is one pass over all documents. No document, term or group is left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.blocks import blocks
from martflow.llm.tables import store

TOP = 10
#: Distinct (item, term) entries of a block of items; a larger item is a block of its own.
BLOCK_TERMS = 200_000
#: A segment ends with the document that reaches one of these.
SEGMENT_BYTES, SEGMENT_DOCS = 8 << 20, 1 << 14
#: Bytes of a text whose terms are listed at a time.
PIECE_BYTES = 1 << 20
#: Documents scored in an item's first round; each further round takes four times as many.
FIRST_ROUND = 64

# fixed values: terms, and the parameters of the score
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = bytes.maketrans(_UPPER.encode(), _LOWER.encode())
FLAT, SLOPE = 100 - 75, 75
SCALE = 1_000_000_000


# --- items ---------------------------------------------------------------------


@dataclass(frozen=True)
class Items:
    """A block of items: the id, term numbers and repeats of each, and the terms' numbers."""

    ids: list
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: dict[bytes, int]


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``(item, term, repeats)``. Equal rows count once, different texts of one id are one item."""
    rows = items.select(F.col(key).alias("item"), F.col(text).alias("text")).distinct()
    lowered = F.translate("text", _UPPER, _LOWER)
    terms = rows.select("item", F.explode(F.regexp_extract_all(lowered, F.lit(_TERM), F.lit(0))).alias("term"))
    return terms.groupBy("item", "term").agg(F.count(F.lit(1)).alias("repeats"))


def item_blocks(terms: DataFrame, limit: int = BLOCK_TERMS) -> Iterator[Items]:
    """Items in blocks; the driver reads one sorted partition of the items' terms at a time."""
    ids, numbers, counts, vocabulary, size = [], [], [], {}, 0
    for row in terms.orderBy("item", "term").toLocalIterator():
        if not ids or row["item"] != ids[-1]:
            if size >= limit:
                yield _block(ids, numbers, counts, vocabulary)
                ids, numbers, counts, vocabulary, size = [], [], [], {}, 0
            ids.append(row["item"])
            numbers.append([])
            counts.append([])
        numbers[-1].append(vocabulary.setdefault(row["term"].encode(), len(vocabulary)))
        counts[-1].append(row["repeats"])
        size += 1
    if ids:
        yield _block(ids, numbers, counts, vocabulary)


def _block(ids: list, numbers: list, counts: list, vocabulary: dict) -> Items:
    return Items(ids, [np.array(x, np.int64) for x in numbers], [np.array(x, np.int64) for x in counts], vocabulary)


# --- the index -----------------------------------------------------------------


def _found(raw: bytes, vocabulary: dict[bytes, int]) -> tuple[int, list[np.ndarray]]:
    """Number of terms of a text, and the numbers of those in the vocabulary."""
    count, hits, start = 0, [], 0
    while start < len(raw):
        end = min(start + PIECE_BYTES, len(raw))
        if end < len(raw):
            gap = _GAP.search(raw, end)
            end = gap.start() if gap else len(raw)
        terms = _TERMS.findall(raw, start, end)
        numbers = np.fromiter(map(vocabulary.get, terms, repeat(-1)), np.int32, len(terms))
        count += len(terms)
        hits.append(numbers[numbers >= 0])
        start = end
    return count, hits


class _Segment:
    def __init__(self) -> None:
        self.keys: list[pa.Array] = []
        self.sizes: list[int] = []
        self.hits: list[np.ndarray] = []
        self.places: list[int] = []
        self.bytes = 0

    def row(self, width: int) -> pa.RecordBatch:
        lengths = [len(x) for x in self.hits]
        place = np.repeat(np.array(self.places, np.int64), lengths)
        term = np.concatenate(self.hits) if self.hits else np.zeros(0, np.int32)
        pairs, counts = np.unique(place * width + term, return_counts=True)
        place, term = pairs // width, pairs % width
        order = np.argsort(term, kind="stable")
        terms, held = np.unique(term, return_counts=True)
        keys = pa.concat_arrays(self.keys)

        def one(values: pa.Array) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        columns = {
            "keys": one(keys),
            "sizes": one(pa.array(self.sizes, pa.int64())),
            "terms": one(pa.array(terms, pa.int32())),
            "held": one(pa.array(held, pa.int64())),
            "places": one(pa.array(place[order], pa.int32())),
            "counts": one(pa.array(counts[order], pa.int64())),
        }
        return pa.RecordBatch.from_pydict(columns)


def index(
    docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int], segment_docs: int = SEGMENT_DOCS
) -> DataFrame:
    """The stored segments of all documents, over the terms of *vocabulary*."""
    width = max(1, len(vocabulary))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment()
        for batch in batches:
            for first, offsets, data in blocks(batch.column(1)):
                raw = data.tobytes().translate(_LOWERED)
                kept = first
                for n, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    count, hits = _found(raw[start:end], vocabulary)
                    segment.hits += hits
                    segment.places += [len(segment.sizes)] * len(hits)
                    segment.sizes.append(count)
                    segment.bytes += end - start
                    if segment.bytes >= SEGMENT_BYTES or len(segment.sizes) >= segment_docs:
                        segment.keys.append(batch.column(0).slice(kept, first + n + 1 - kept))
                        yield segment.row(width)
                        segment, kept = _Segment(), first + n + 1
                if kept < first + len(offsets) - 1:
                    segment.keys.append(batch.column(0).slice(kept, first + len(offsets) - 1 - kept))
        if segment.sizes:
            yield segment.row(width)

    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("held", T.ArrayType(T.LongType())),
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
        ]
    )
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return store(rows.mapInArrow(build, schema), "segments")


@dataclass(frozen=True)
class Corpus:
    """Counts over all documents; ``held`` and ``weights`` are by term number."""

    documents: int
    terms: int
    held: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        n = 2 * self.documents + 2
        return np.array([math.floor(1000 * math.log(n / (2 * x + 1))) for x in self.held.tolist()], np.int64)


def corpus(segments: DataFrame, vocabulary: dict[bytes, int]) -> Corpus:
    """Sums over the segments; a row per term of the vocabulary reaches the driver."""
    with_terms = F.size(F.filter("sizes", lambda x: x > 0)).cast("bigint")
    all_terms = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    total = segments.agg(F.sum(with_terms).alias("n"), F.sum(all_terms).alias("l")).first()
    pairs = segments.select(F.inline(F.arrays_zip("terms", "held")))
    held = np.zeros(len(vocabulary), np.int64)
    for row in pairs.groupBy("terms").agg(F.sum("held").alias("held")).collect():
        held[row["terms"]] = row["held"]
    return Corpus(total["n"] or 0, total["l"] or 0, held)


# --- answers -------------------------------------------------------------------


class _Answers:
    """The best documents of each item so far: ``(-score, key is NULL, key)``, ten at most."""

    def __init__(self, items: Items, counts: Corpus, top: int):
        self.items, self.counts, self.top = items, counts, top
        weights = counts.weights
        self.gains = [weights[t] * r for t, r in zip(items.terms, items.repeats, strict=True)]
        self.best: list[list[tuple]] = [[] for _ in items.ids]

    def least(self, item: int) -> int:
        """A document below this score cannot enter the answers of the item."""
        best = self.best[item]
        return -best[-1][0] if len(best) == self.top else 1

    def add(self, item: int, scores: np.ndarray, places: np.ndarray, keys: pa.Array) -> None:
        least = self.least(item)
        if len(scores) > self.top:
            least = max(least, int(np.partition(scores, -self.top)[-self.top]))
        good = np.flatnonzero(scores >= least)
        if len(good):
            named = keys.take(pa.array(places[good])).to_pylist()
            new = [(-s, k is None, k) for s, k in zip(scores[good].tolist(), named, strict=True)]
            self.best[item] = sorted(self.best[item] + new, key=_order)[: self.top]

    def search(self, segment: dict) -> None:
        """Answer every item from one segment."""
        keys, sizes = segment["keys"], segment["sizes"]
        terms, held = segment["terms"], segment["held"]
        places, counts = segment["places"], segment["counts"]
        if not len(terms):
            return
        n, all_ = self.counts.documents, self.counts.terms
        drag = np.array([8 * (FLAT + SLOPE * x * n // all_) for x in sizes.tolist()], np.int64)
        part = (SCALE * counts) // (1000 * counts + drag[places])
        starts = np.cumsum(held) - held
        peak = np.maximum.reduceat(part, starts)
        slot = np.full(len(self.counts.held), -1, np.int64)
        slot[terms] = np.arange(len(terms))
        # the same postings by document
        by_doc = np.argsort(places, kind="stable")
        doc_slot, doc_part = np.repeat(np.arange(len(terms)), held)[by_doc], part[by_doc]
        first = np.searchsorted(places[by_doc], np.arange(len(sizes) + 1))
        bitmaps: dict[int, np.ndarray] = {}
        gain_of = np.zeros(len(terms), np.int64)

        def bitmap(s: int) -> np.ndarray:
            if s not in bitmaps:
                row = np.zeros(len(sizes), bool)
                row[places[starts[s] : starts[s] + held[s]]] = True
                bitmaps[s] = np.packbits(row)
            return bitmaps[s]

        for item, gains in enumerate(self.gains):
            slots = slot[self.items.terms[item]]
            here = (slots >= 0) & (gains > 0)
            slots, gains = slots[here], gains[here]
            bounds = gains * peak[slots]
            if not len(slots) or int(bounds.sum()) < self.least(item):
                continue
            groups = mask_groups(np.stack([bitmap(s) for s in slots.tolist()]), len(sizes), bounds)
            gain_of[slots] = gains
            for bound, members in groups:
                if bound < self.least(item):
                    break
                lengths = first[members + 1] - first[members]
                ends = np.cumsum(lengths)
                at = np.repeat(first[members] - ends + lengths, lengths) + np.arange(int(ends[-1]))
                scores = np.add.reduceat(gain_of[doc_slot[at]] * doc_part[at], ends - lengths)
                self.add(item, scores, members, keys)
            gain_of[slots] = 0


def _order(x: tuple) -> tuple:
    return (x[0], 1) if x[1] else (x[0], 0, x[2])


def mask_groups(bitmaps: np.ndarray, size: int, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(maximum score, documents)`` of rounds of presence masks, by descending maximum.

    *bitmaps* has a row of packed bits per term. Documents without a term are in no group. A round
    holds the documents of whole masks, and its maximum is that of its best mask.
    """
    present = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps), count=size))
    if not len(present):
        return
    turned = np.packbits(np.unpackbits(bitmaps, axis=1, count=size)[:, present], axis=0)
    wide = np.zeros((-(-len(turned) // 8) * 8, len(present)), np.uint8)
    wide[: len(turned)] = turned
    words = np.ascontiguousarray(wide.T).view(np.uint64)
    group = np.unique(words[:, 0], return_inverse=True)[1]
    for column in words.T[1:]:
        other = np.unique(column, return_inverse=True)[1]
        group = np.unique(group * len(present) + other, return_inverse=True)[1]
    _, one = np.unique(group, return_index=True)
    # the maximum of a mask, a byte of eight terms at a time
    padded = np.zeros(len(turned) * 8, np.int64)
    padded[: len(bounds)] = bounds
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
    tables = bits @ padded.reshape(-1, 8).T
    most = np.zeros(len(one), np.int64)
    for k in range(len(turned)):
        most += tables[turned[k, one], k]
    order = np.argsort(-most, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rank = place[group]
    sorted_ = present[np.argsort(rank, kind="stable")]
    ends = np.cumsum(np.bincount(rank))
    start, least, mask = 0, FIRST_ROUND, 0
    while start < len(sorted_):
        last = min(int(np.searchsorted(ends, start + least)), len(ends) - 1)
        yield int(most[order[mask]]), sorted_[start : ends[last]]
        start, mask, least = int(ends[last]), last + 1, least * 4


def answers(segments: DataFrame, items: Items, counts: Corpus, top: int) -> DataFrame:
    """``(item, key, score)``: at most *top* documents per item and task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, kind = _Answers(items, counts, top), None
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kind = columns["keys"].type.value_type
            for row in range(batch.num_rows):
                one = {name: column.slice(row, 1).flatten() for name, column in columns.items()}
                found.search({k: v if k == "keys" else v.to_numpy(zero_copy_only=False) for k, v in one.items()})
        rows = [(i, x[2], -x[0]) for i, best in enumerate(found.best) for x in best]
        if rows:
            item, key, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(key, kind), pa.array(score, pa.int64())],
                names=["number", "key", "score"],
            )

    schema = T.StructType(
        [
            T.StructField("number", T.LongType()),
            T.StructField("key", segments.schema["keys"].dataType.elementType),
            T.StructField("score", T.LongType()),
        ]
    )
    return segments.mapInArrow(run, schema)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    segment_docs: int = SEGMENT_DOCS,
) -> DataFrame:
    """``(item, rank, key, score)``: the *top* documents of every item with a score above 0.

    Equal scores come by ascending key, NULL last. NULL and empty texts have no terms: such documents
    answer nothing and count nowhere, such items have no rows. Each row of *docs* is a document of its own, also
    one that is repeated or shares a key; equal rows of *items* count once, and different texts of one id, NULL
    included, form one item. Other columns are left out, whatever their names. Without documents or
    items there are no rows.
    """
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType
    names = T.StructType([T.StructField("number", T.LongType()), T.StructField("item", kind)])
    result = spark.createDataFrame(
        [], T.StructType([T.StructField("item", kind), T.StructField("rank", T.IntegerType()),
                          T.StructField("key", docs.schema[key].dataType), T.StructField("score", T.LongType())])
    )
    for block in item_blocks(store(item_terms(items, item_key, item_text), "item-terms"), block_terms):
        segments = index(docs, key, text, block.vocabulary, segment_docs)
        counts = corpus(segments, block.vocabulary)
        if not counts.documents:
            break
        best = answers(segments, block, counts, top)
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("key"))
        placed = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        # a block has at most block_terms items
        ids = F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), names))
        result = result.unionByName(placed.join(ids, "number").select("item", "rank", "key", "score"))
    return result.select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")
