"""Packing of documents into sequences of fixed length, by the histogram of lengths.

Texts are cut into pieces of at most one sequence. What is packed is the histogram of the
pieces' lengths, not the pieces: lengths are placed longest first, each into the
patterns (multisets of lengths, with a count of sequences) that are shortest so far, and
patterns are split where only some of their sequences take a piece. The histogram has at
most as many entries as a sequence has places, so this work is the same for any number of
documents. Pieces then find their sequence by their rank among all pieces in the
order of length, which the patterns cover in intervals.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.tokens import default_tokenizer, encoded, encoder
from martflow.sources.workdir import store

SEQUENCE = 4096
_PIECE = "key bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(
    df: DataFrame, key: str, text: str, tokenizer: str | None = None, size: int = SEQUENCE, with_ids: bool = False
) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens)`` of every piece, and its ids if asked for.

    A text's ids, the end id included, are cut every *size* ids. NULL is the empty text.
    """
    tokenizer = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            keys = batch.column(0)
            for first, ids, at in encoded(batch.column(1), coder):
                total = np.diff(at)
                many = (total + size - 1) // size
                row = np.repeat(np.arange(len(total)), many)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * size
                length = np.minimum(size, total[row] - start)
                begin = at[:-1][row] + start
                own = [
                    ids[a:b].astype("<u4") for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)
                ]
                columns = [
                    keys.take(pa.array(first + row)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                    pa.array(total[row]),
                ]
                names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array([x.tolist() for x in own], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    plain = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return plain.mapInArrow(cut, _PIECE + (", ids array<bigint>" if with_ids else ""))


@dataclass(frozen=True)
class Plan:
    """Where the pieces go, in the order of length: pieces from rank ``first`` on take ``each``
    places side by side in sequence ``sequence``, the next ``each`` in the next sequence."""

    first: np.ndarray
    length: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan(histogram: dict[int, int], size: int = SEQUENCE) -> Plan:
    """Pack a histogram of lengths: longest first, into the shortest patterns that have room.

    *histogram* has lengths from 1 to *size*. A pattern is ``(used, count, parts)``; parts
    are (length, how often in each sequence).
    """
    open_: list[tuple[int, int, int, tuple]] = []  # used, order, count, parts
    done: list[tuple[int, tuple]] = []
    order = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        ready = []
        while left and open_ and open_[0][0] + length <= size:
            used, _, count, parts = heapq.heappop(open_)
            # as many into each sequence of the pattern as all of them can share, but no more
            # than lets the other patterns of this length stay as short
            each = max(1, min((size - used) // length, left // count)) if left >= count else 1
            next_used = open_[0][0] if open_ else size
            each = max(1, min(each, (next_used - used) // length + 1))
            took = min(count, left // each)
            if took < count:
                order += 1
                heapq.heappush(open_, (used, order, count - took, parts))
            left -= took * each
            order += 1
            heapq.heappush(open_, (used + each * length, order, took, (*parts, (length, each))))
        each = size // length
        if left >= each:
            order += 1
            ready.append((each * length, order, left // each, ((length, each),)))
            left -= each * (left // each)
        if left:
            order += 1
            ready.append((left * length, order, 1, ((length, left),)))
        for entry in ready:
            heapq.heappush(open_, entry)
        while open_ and open_[0][0] == size:
            _, _, count, parts = heapq.heappop(open_)
            done.append((count, parts))
    done += [(count, parts) for _, _, count, parts in sorted(open_)]
    begin, total = {}, 0
    for length in sorted(histogram):
        begin[length] = total
        total += histogram[length]
    rows, sequence = [], 0
    for count, parts in done:
        offset = 0
        for length, each in parts:
            rows.append((begin[length], length, each, sequence, offset))
            begin[length] += count * each
            offset += length * each
        sequence += count
    rows.sort()
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    return Plan(*(np.array(list(c), np.int64) for c in columns), sequence)


_PART, _PLACE = "part", "place"


def _ranked(rows: DataFrame) -> DataFrame:
    """The rows with their rank from 0 on, in the order of length, key and start.

    Rows are dealt by range and stored with their place in their partition; the sizes
    of the partitions before, one row for each, make the place a rank.
    """
    order = ["length", "key", "start", "ids_crc32"]
    number = F.monotonically_increasing_id()
    placed = store(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_PLACE, number.bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked",
    )
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_PART, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), _PART).withColumn("rank", F.col(_PLACE) + F.col("offset"))


def pack(rows: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table of pieces.

    Every piece keeps its row. Rows that agree in length, key, start and ids are interchangeable.
    """
    # stored, since dealing by range reads its input twice
    ranked = _ranked(store(rows, "pieces"))
    counts = ranked.groupBy("length").count().collect()  # at most *size* rows
    plan_ = plan({r["length"]: r["count"] for r in counts}, size)
    columns = [c for c in rows.columns]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            i = np.searchsorted(plan_.first, rank, "right") - 1
            inside = rank - plan_.first[i]
            sequence = plan_.sequence[i] + inside // plan_.each[i]
            offset = plan_.offset[i] + inside % plan_.each[i] * plan_.length[i]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"]
            )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ranked.select(*columns, "rank").mapInArrow(placed, f"{types}, sequence_id bigint, offset bigint")


def packed(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, a row for each piece.

    A NULL or empty text is the end id alone. Repeated rows and NULL keys are packed like others.
    """
    return pack(pieces(df, key, text, tokenizer, size), size).withColumnRenamed("key", key)


def sequences(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """``(sequence_id, ids)``: the ids of every sequence, at most *size* of them, without padding."""
    rows = pack(pieces(df, key, text, tokenizer, size, with_ids=True), size)
    parts = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("x"))
    return parts.select("sequence_id", F.flatten(F.transform("x", lambda p: p["ids"])).alias("ids"))
