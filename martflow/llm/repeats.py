"""Exact repeats of a fixed length, by column-wise sorting of many documents.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier. Inserting
whole documents into one collection transform, a symbol of each per round, would take
as many rounds as the longest document has bytes, each over files of the size of all
text. Only the first ``LENGTH`` columns of the order are asked for, though, so the
column-wise construction is cut down to them:

* Every string of ``LENGTH`` bytes is led by an anchor, the least of its substrings of ``ANCHOR``
  bytes in the order of a hash. Equal strings have equal anchors at the same place, so
  the strings of one anchor can be sorted by one task.
* Neighbouring strings with the same anchor form a run. Equal runs are settled by their
  hashes: all but the first are repeats, first within a block of text, then across
  blocks, so that a run that occurs everywhere costs a row per block.
* What is left are anchors with several different runs, which meet where passages begin or end.
  Their contexts are inserted column by column: each round takes the next symbol of every context,
  to the right and to the left of the anchor, and refines the ranks of all contexts by
  it. After d rounds two contexts have the same rank if their common prefix has d symbols;
  two strings are equal if both ranks agree at their lengths.
* Hot anchors, those with most of the different runs, are not sorted by one task: their runs are taken
  apart into strings, which are settled by their hashes, in a block and then dealt by them.
  They are found in a sample; it decides where a run is settled, not whether.

Texts are read twice, a sample of them thrice, and shuffled once; the two joins with the texts use the same shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.blocks import blocks, running, scatter, spans
from martflow.operators.keys import surrogate_keys
from martflow.sources.workdir import store

LENGTH = 100
ANCHOR = 40
#: Strings of a block that are looked at together, at about 100 bytes each; places within them take 24 bits.
PIECE = 1 << 19
_PLACE_BITS = 24
#: One of so many short texts, and of pieces of long ones, is in the sample for hot anchors.
SAMPLE, SAMPLE_BYTES = 32, 1 << 14
#: Different runs in the sample that make an anchor hot, and how many hot anchors there are at most.
HOT_RUNS, HOT_ANCHORS = 16, 100_000
#: Contexts that are sorted together, at about 3 KB each, unless one anchor has more.
SORTED = 1 << 12
_RUN = np.dtype(
    [("anchor", "<u8"), ("run", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("lead", "<u2"), ("size", "<u2")]
)
#: What a dealt row holds: runs by their anchor, settled runs by document, strings of hot anchors by hash.
_RUNS, _SETTLED, _STRINGS = 0, 1, 2
_FOUND = "doc bigint, open boolean, start bigint, size int, lead int, anchor bigint"
_GONE = "doc bigint, start bigint, end bigint"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every *width* neighbours."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """Runs of the strings of a block: ``doc`` is the row, ``start`` the place in its text."""
    out = []
    sizes = np.diff(offsets)
    ends = np.repeat(offsets[1:], sizes)
    for low in range(0, max(0, len(data) - length + 1), PIECE):
        part = data[low : low + PIECE + length - 1]
        prefix = running(part)
        place = np.arange(len(part) - anchor + 1)
        marks = spans(prefix, place, place + anchor)
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        lead = _least((marks & ~mask) | place.astype(np.uint64), length - anchor + 1) & mask
        start = np.flatnonzero(ends[low : low + len(lead)] - np.arange(low, low + len(lead)) >= length)
        if not len(start):
            continue
        own = lead[start].astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        begin, end, at = start[first], start[last] + length, own[first]
        found = np.zeros(len(first), _RUN)
        row = np.searchsorted(offsets, begin + low, "right") - 1
        found["anchor"], found["run"] = marks[at], spans(prefix, begin, end)
        found["doc"], found["start"] = row, begin + low - offsets[row]
        found["lead"], found["size"] = at - begin, end - begin
        out.append(found)
    return np.concatenate(out) if out else np.zeros(0, _RUN)


def _repeated(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs in the order of anchor, run and place, and which of them repeat an earlier one."""
    found = found[np.lexsort((found["start"], found["doc"], found["run"], found["anchor"]))]
    again = np.zeros(len(found), bool)
    again[1:] = (found["anchor"][1:] == found["anchor"][:-1]) & (found["run"][1:] == found["run"][:-1])
    return found, again


def strings(data: np.ndarray, offsets: np.ndarray, found: np.ndarray, length: int) -> np.ndarray:
    """The strings of some runs of a block, each as a run of its own."""
    begin = offsets[found["doc"]] + found["start"]
    order = np.argsort(begin, kind="stable")
    found, begin = found[order], begin[order]
    out = []
    edges = np.searchsorted(begin, np.arange(0, len(data) + PIECE, PIECE))
    for low, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if a == b:
            continue
        own, at = found[a:b], begin[a:b] - low * PIECE
        many = own["size"].astype(np.int64) - length + 1
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        single = np.repeat(own, many)
        at = np.repeat(at, many) + step
        last = int(at.max()) + length
        single["run"] = spans(running(data[low * PIECE : low * PIECE + last]), at, at + length)
        single["start"] += step.astype(np.uint32)
        single["lead"] -= step.astype(np.uint16)
        single["size"] = length
        out.append(single)
    return np.concatenate(out) if out else np.zeros(0, _RUN)


def _joined(single: np.ndarray, length: int) -> np.ndarray:
    """Neighbouring strings of one run as one record."""
    single = single[np.lexsort((single["start"], single["doc"]))]
    new = np.ones(len(single), bool)
    new[1:] = (
        (single["doc"][1:] != single["doc"][:-1])
        | (single["anchor"][1:] != single["anchor"][:-1])
        | (single["start"][1:] != single["start"][:-1] + 1)
        | (single["lead"][1:] + 1 != single["lead"][:-1])
    )
    first = np.flatnonzero(new)
    out = single[first]
    out["size"] = np.diff(np.append(first, len(single))) + length - 1
    return out


def _dealt(found: np.ndarray, parts: int, extra: list[bytes] | None = None, by: np.ndarray | None = None) -> pa.RecordBatch:
    """Records as one binary row for each part of the anchors, or of other numbers."""
    by = found["anchor"] if by is None else by
    part = (scatter(by) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    found, part = found[order], part[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    last = np.append(first[1:], len(part))[: len(first)]
    blobs = [found[a:b].tobytes() for a, b in zip(first, last, strict=True)]
    columns = [pa.array(part[first]), pa.array(blobs, pa.binary())]
    if extra is not None:
        columns.append(pa.array([b"".join(extra[i] for i in order[a:b]) for a, b in zip(first, last, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["part", "runs", "bytes"][: len(columns)])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """All rows of each part, from batches in the order of parts."""
    held, now = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != now and held:
                yield held
                held = []
            now = row[0]
            held.append(row[1:])
    if held:
        yield held


def _found_batch(found: np.ndarray, open_: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(found["doc"]),
            pa.array(np.full(len(found), open_)),
            pa.array(found["start"].astype(np.int64)),
            pa.array(found["size"].astype(np.int32)),
            pa.array(found["lead"].astype(np.int32)),
            pa.array(found["anchor"].view(np.int64)),
        ],
        ["doc", "open", "start", "size", "lead", "anchor"],
    )


def _hot_anchors(texts: DataFrame, length: int, anchor: int) -> np.ndarray:
    """Anchors with many different runs in a sample of the texts, in order."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, offsets, data in blocks(batch.column(1)):
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    places = np.arange(a, b, SAMPLE_BYTES)
                    if b - a > SAMPLE_BYTES:
                        marks = scatter(keys[row + i : row + i + 1].view(np.uint64) + places.astype(np.uint64) - np.uint64(a))
                        places = places[marks % np.uint64(SAMPLE) == 0]
                    for low in places.tolist():
                        part = data[low : min(b, low + SAMPLE_BYTES + length - 1)]
                        found = runs(part, np.array([0, len(part)]), length, anchor)
                        columns = [pa.array(found[x].view(np.int64) if len(found) else [], pa.int64()) for x in ("anchor", "run")]
                        yield pa.RecordBatch.from_arrays(columns, ["anchor", "run"])

    some = texts.filter((F.octet_length("text") > SAMPLE_BYTES) | (F.pmod(F.xxhash64("doc"), F.lit(SAMPLE)) == 0))
    found = some.mapInArrow(sampled, "anchor bigint, run bigint").distinct().groupBy("anchor").count()
    hot = found.filter(F.col("count") >= HOT_RUNS).orderBy(F.desc("count"), "anchor").limit(HOT_ANCHORS).collect()
    return np.sort(np.array([r["anchor"] for r in hot], np.int64).view(np.uint64))


def _classes(texts: DataFrame, length: int, anchor: int, parts: int) -> DataFrame:
    """Runs that repeat an earlier run, and, as ``open``, those whose anchor has other runs too.

    The runs of hot anchors are settled string by string, so none of them is open.
    """
    hot = _hot_anchors(texts, length, anchor)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, offsets, data in blocks(batch.column(1)):
                found = runs(data, offsets, length, anchor)
                doc = found["doc"].copy()
                found["doc"] = keys[row + doc]
                order = np.lexsort((found["start"], found["doc"], found["run"], found["anchor"]))
                found, again = _repeated(found)
                gone, found, doc = found[again], found[~again], doc[order][~again]
                taken = np.isin(found["anchor"], hot)
                if taken.any():
                    own = found[taken]
                    own["doc"] = doc[taken]
                    single = strings(data, offsets, own, length)
                    single["doc"] = keys[row + single["doc"]]
                    single, again = _repeated(single)
                    gone = np.concatenate([gone, _joined(single[again], length)])
                    single = single[~again]
                    yield _tagged(_dealt(single, parts, by=single["run"]), _STRINGS)
                yield _tagged(_dealt(found[~taken], parts), _RUNS)
                # what is settled has no need to meet its anchor
                yield _tagged(_dealt(gone, parts, by=gone["doc"].view(np.uint64)), _SETTLED)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches):
            known = [np.frombuffer(b, _RUN) for b, kind in rows if kind == _SETTLED]
            if known:
                yield _found_batch(np.concatenate(known), False)
            single = [np.frombuffer(b, _RUN) for b, kind in rows if kind == _STRINGS]
            if single:
                found, again = _repeated(np.concatenate(single))
                yield _found_batch(_joined(found[again], length), False)
            left = [np.frombuffer(b, _RUN) for b, kind in rows if kind == _RUNS]
            if not left:
                continue
            found, again = _repeated(np.concatenate(left))
            yield _found_batch(found[again], False)
            found = found[~again]
            same = found["anchor"][1:] == found["anchor"][:-1]
            several = np.zeros(len(found), bool)
            several[1:] |= same
            several[:-1] |= same
            yield _found_batch(found[several], True)

    dealt = texts.mapInArrow(first, "part bigint, runs binary, kind int")
    dealt = dealt.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(second, _FOUND)


def _tagged(batch: pa.RecordBatch, kind: int) -> pa.RecordBatch:
    flag = pa.array(np.full(len(batch), kind, np.int32))
    return pa.RecordBatch.from_arrays([*batch.columns, flag], ["part", "runs", "kind"])


def _ranks(group: np.ndarray, symbols: np.ndarray) -> list[np.ndarray]:
    """Column-wise ranks: entry d tells contexts apart by their group and first d symbols.

    Each round inserts one symbol of every context. Symbols are 0 to 255, or 256 past the end.
    """
    out = [group]
    for d in range(symbols.shape[1]):
        key = out[-1] * 257 + symbols[:, d]
        out.append(np.unique(key, return_inverse=True)[1].astype(np.int64))
    return out


def common_strings(found: np.ndarray, data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Spans (doc, start, end) of strings that start earlier too, among the runs of some anchors.

    *data* holds the bytes of the runs, one after the other.
    """
    order = np.lexsort((found["start"], found["doc"]))
    begin = (np.cumsum(found["size"].astype(np.int64)) - found["size"])[order]
    found = found[order]
    size, lead = found["size"].astype(np.int64), found["lead"].astype(np.int64)
    group = np.unique(found["anchor"], return_inverse=True)[1].astype(np.int64)
    width = length - anchor
    step = np.arange(width)[None, :]
    right = (lead + anchor)[:, None] + step
    left = lead[:, None] - 1 - step
    cells = np.append(data, 0).astype(np.int16)
    symbols = np.where(right < size[:, None], cells[np.minimum(begin[:, None] + right, len(data))], 256)
    after = _ranks(group, symbols)
    symbols = np.where(left >= 0, cells[np.maximum(begin[:, None] + left, 0)], 256)
    before = _ranks(group, symbols)
    again = np.zeros((len(found), width + 1), bool)
    for o in range(width + 1):  # the string begins o bytes before the anchor
        has = np.flatnonzero((lead >= o) & (size - lead - anchor >= width - o))
        key = before[o][has] * (int(after[width - o].max(initial=0)) + 1) + after[width - o][has]
        again[has, o] = True
        again[has[np.unique(key, return_index=True)[1]], o] = False  # rows are in order: the first stays
    edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1  # of the same rows, in the same order
    at = found["start"].astype(np.int64)[row] + lead[row]
    return found["doc"][row], at - high, at - low + length


def _whole_anchors(anchors: np.ndarray) -> Iterator[slice]:
    """Slices of sorted anchors that hold each anchor whole and, with several anchors, at most ``SORTED`` rows."""
    edges = [*np.flatnonzero(np.diff(anchors)) + 1, len(anchors)]
    low = high = 0
    for edge in edges:
        if edge - low > SORTED and high > low:
            yield slice(low, high)
            low = high
        high = int(edge)
    if high > low:
        yield slice(low, high)


def _open_spans(texts: DataFrame, found: DataFrame, length: int, anchor: int, parts: int) -> DataFrame:
    """Repeats among the runs that are open."""
    wanted = found.filter("open").groupBy("doc").agg(
        F.collect_list(F.struct("start", "size", "lead", "anchor")).alias("runs")
    )

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records, cut = [], []
            for i in range(len(batch)):
                raw = batch.column(1)[i].as_py().encode()
                own = batch.column(2)[i].values
                rows = np.zeros(len(own), _RUN)
                rows["doc"] = batch.column(0)[i].as_py()
                for name in ("start", "size", "lead"):
                    rows[name] = own.field(name).to_numpy()
                rows["anchor"] = own.field("anchor").to_numpy().view(np.uint64)
                records.append(rows)
                cut += [raw[a : a + b] for a, b in zip(rows["start"].tolist(), rows["size"].tolist(), strict=True)]
            if records:
                yield _dealt(np.concatenate(records), parts, cut)

    def sorted_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _gathered(batches):
            own = np.concatenate([np.frombuffer(a, _RUN) for a, _ in rows])
            data = b"".join(b for _, b in rows)
            ends = np.cumsum(own["size"].astype(np.int64))
            order = np.argsort(own["anchor"], kind="stable")
            for few in _whole_anchors(own["anchor"][order]):
                some = order[few]
                cells = b"".join(data[b - n : b] for b, n in zip(ends[some].tolist(), own["size"][some].tolist(), strict=True))
                doc, start, end = common_strings(own[some], np.frombuffer(cells, np.uint8), length, anchor)
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(end)], ["doc", "start", "end"])

    joined = texts.join(wanted, "doc").select("doc", "text", "runs")
    dealt = joined.mapInArrow(contexts, "part bigint, runs binary, bytes binary")
    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(sorted_, _GONE)


def _numbered(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``(doc, key, text)`` with documents numbered in their order, and ``(doc, text)`` of each once.

    Keys that are unique and not NULL are the numbers themselves. Otherwise documents, as pairs of
    key (NULL first) and a hash of the text, are numbered in that order.
    """
    value = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = df.select(F.col(key).cast("bigint").alias("key"), value)
    repeated = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR key IS NULL")
    if repeated.isEmpty():
        rows = rows.select(F.coalesce("key", F.lit(0)).alias("doc"), "key", "text")
        return rows, rows.select("doc", "text")
    rows = rows.select(
        "key", "text", F.col("key").isNotNull().alias("known"),
        F.coalesce("key", F.lit(0)).alias("k"), F.xxhash64("text").alias("mark"),
    )
    numbers = surrogate_keys(rows, ["known", "k", "mark"], "doc")
    rows = rows.join(numbers, ["known", "k", "mark"])
    rows = store(rows.select(F.coalesce("doc", F.lit(0)).alias("doc"), "key", "text"), "numbered")
    return rows, store(rows.select("doc", "text").dropDuplicates(["doc"]), "numbered_once")


def _union(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(start.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, with_bytes: bool = False
) -> DataFrame:
    """``(key, n_bytes, spans, kept_sha256)``, and ``kept`` if asked for, a row for each row of *df*.

    ``spans`` are the maximal runs of removed bytes, end exclusive, of the text as UTF-8; ``kept`` is what
    remains, which need not be UTF-8. Documents are ordered by key; rows that agree in key and text are one
    document and each gives its own row, and others of equal or NULL keys are ordered by a hash of
    their text, NULL keys first. NULL is the empty text.
    """
    texts, once = _numbered(df, key, text)
    spark = df.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = store(_classes(once, length, anchor, parts), "runs")
    gone = found.filter("NOT open").select("doc", "start", (F.col("start") + F.col("size")).alias("end"))
    gone = gone.unionByName(_open_spans(once, found, length, anchor, parts))
    spans_ = gone.groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        names = ["key", "n_bytes", "spans", "kept_sha256", "kept"]
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                raw = batch.column("text")[i].as_py().encode()
                starts = batch.column("starts")[i]
                found = _union(starts.values.to_numpy(), batch.column("ends")[i].values.to_numpy()) if starts.is_valid else []
                kept, at = [], 0
                for a, b in found:
                    kept.append(raw[at:a])
                    at = b
                kept = b"".join([*kept, raw[at:]])
                mark = hashlib.sha256(kept).hexdigest()
                rows.append((len(raw), [{"start": a, "end": b} for a, b in found], mark, kept if with_bytes else None))
            size, own, marks, kept = zip(*rows, strict=True) if rows else ([], [], [], [])
            columns = [batch.column("key"), pa.array(size, pa.int64()), pa.array(own, pa.list_(pair)), pa.array(marks, pa.string())]
            if with_bytes:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    schema = "key bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    out = texts.select("doc", "text", "key").join(spans_, "doc", "left").mapInArrow(cut, schema + ", kept binary" * with_bytes)
    return out.withColumnRenamed("key", key)

