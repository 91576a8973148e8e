"""Token ids in shards with a minimal perfect hash index.

A shard is one row of the written table: the raw little-endian ids of its documents, in
key order, and an index from key to place. The index is a minimal perfect hash
function, so a key leads to its slot without keys being stored: a chain of bit arrays, where
a key that meets no other in one array is settled there, and its slot is the number of set
bits before its own. Each slot holds a fingerprint of its key, which turns away
keys that the shard does not have, and where the key's ids begin. A lookup touches one
shard (by its least and greatest key) and a handful of cells, however many keys there are.

Shards are rows of a Parquet table, not loose files, so they can lie wherever Spark can
write, and a task that is run again leaves no half-written shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.blocks import scatter
from martflow.llm.tokens import END, default_tokenizer, encoded, encoder
from martflow.sources.workdir import run_folder

SHARD_IDS = 2_000_000
#: Cells per key in each bit array.
LOOSE = 2.0
SCHEMA = (
    "shard bigint, least bigint, greatest bigint, n_ids bigint, width int, ids binary, starts binary, "
    "keys binary, levels array<int>, bits binary, ranks binary, prints binary, slots binary"
)
_LEVEL = 0x9E3779B97F4A7C15
_RANK_CELLS = 512


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    turn = np.uint64((level + 1) * _LEVEL % (1 << 64))
    return scatter(keys.astype(np.int64).view(np.uint64) + turn)


@dataclass(frozen=True)
class PerfectHash:
    """Distinct keys to 0 .. n-1: sizes of the bit arrays, their bits, set bits before each block."""

    levels: np.ndarray
    bits: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, arrays, left = [], [], np.unique(keys)
        while len(left):
            size = max(64, int(LOOSE * len(left)))
            place = (_hash(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(size)
            arrays.append(alone)
            left = left[~alone[place]]
        bits = np.concatenate(arrays) if arrays else np.zeros(0, bool)
        steps = np.add.reduceat(bits, np.arange(0, len(bits), _RANK_CELLS), dtype=np.int64) if len(bits) else []
        ranks = np.concatenate([[0], np.cumsum(steps)])[: max(1, len(steps))]
        return cls(np.array(levels, np.int32), np.packbits(bits), ranks.astype("<u4"))

    def _bit(self, place: np.ndarray) -> np.ndarray:
        return (self.bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1, or any slot, for keys that were not there."""
        out = np.full(len(keys), -1, np.int64)
        base = 0
        for level, size in enumerate(self.levels.tolist()):
            open_ = np.flatnonzero(out < 0)
            place = base + (_hash(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = self._bit(place)
            at = place[hit]
            # set bits of the key's block, up to its own
            first = at - at % _RANK_CELLS
            cells = first[:, None] + np.arange(_RANK_CELLS)[None, :]
            inside = cells < at[:, None]
            before = (self._bit(np.minimum(cells, 8 * len(self.bits) - 1)) & inside).sum(axis=1)
            out[open_[hit]] = self.ranks[at // _RANK_CELLS] + before
            base += size
        return out


def _prints(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def shard_row(number: int, keys: list[int | None], ids: np.ndarray, starts: np.ndarray, width: int) -> dict:
    """One shard from the ids of its documents in key order; NULL keys have no index entry."""
    known = np.array([k for k in keys if k is not None], np.int64)
    nulls = len(keys) - len(known)  # they come first
    distinct, first = np.unique(known, return_index=True)
    index = PerfectHash.build(distinct)
    slot = index.slots(distinct) if len(distinct) else np.zeros(0, np.int64)
    prints, places = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[slot] = _prints(distinct)
    places[slot] = first + nulls
    return {
        "shard": number,
        "least": int(known[0]) if len(known) else None,
        "greatest": int(known[-1]) if len(known) else None,
        "n_ids": len(ids),
        "width": width,
        "ids": ids.astype(f"<u{width}").tobytes(),
        "starts": starts.astype("<u8").tobytes(),
        "keys": np.concatenate([np.zeros(nulls, np.int64), known]).astype("<i8").tobytes()
        + (nulls).to_bytes(8, "little"),
        "levels": index.levels.tolist(),
        "bits": index.bits.tobytes(),
        "ranks": index.ranks.tobytes(),
        "prints": prints.tobytes(),
        "slots": places.tobytes(),
    }


_ARROW = pa.schema(
    [("shard", pa.int64()), ("least", pa.int64()), ("greatest", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())]
    + [(n, pa.binary()) for n in ("ids", "starts", "keys")]
    + [("levels", pa.list_(pa.int32()))]
    + [(n, pa.binary()) for n in ("bits", "ranks", "prints", "slots")]
)


def write_shards(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode all texts and write shards in key order, NULL keys first.

    Rows of equal keys are ordered by a hash of the text and then by the text. Each text is
    followed by the end id; NULL is the empty text. Shards hold about *shard_ids* ids; a
    longer document is a shard of its own. Shard numbers rise with the keys.
    """
    tokenizer = tokenizer or default_tokenizer()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        width = 2 if max(coder.tokenizer.get_vocab_size(), END + 1) <= 1 << 16 else 4
        number = TaskContext.get().partitionId() << 32
        keys, parts, sizes = [], [], []

        def full() -> pa.RecordBatch:
            ends = np.concatenate([[0], np.cumsum(sizes)])
            row = shard_row(number, keys, np.concatenate(parts), ends, width)
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in batches:
            own = batch.column(0).to_pylist()
            for first, ids, at in encoded(batch.column(1), coder):
                keys += own[first : first + len(at) - 1]
                parts.append(ids)
                sizes += np.diff(at).tolist()
                if sum(map(len, parts)) >= shard_ids:
                    yield full()
                    number += 1
                    keys, parts, sizes = [], [], []
        if keys:
            yield full()

    value = F.coalesce(F.col(text), F.lit(""))
    plain = df.select(F.col(key).cast("bigint").alias("key"), value.alias("text"), F.xxhash64(value).alias("mark"))
    ordered = plain.repartitionByRange("key", "mark").sortWithinPartitions("key", "mark", "text")
    ordered.select("key", "text").mapInArrow(shards, SCHEMA).write.parquet(path)


class Shard:
    """A shard that has been read back."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], f"<u{row['width']}")
        self.starts = np.frombuffer(row["starts"], "<u8").astype(np.int64)
        nulls = int.from_bytes(row["keys"][-8:], "little")
        known = np.frombuffer(row["keys"][:-8], "<i8")
        self.keys = [None] * nulls + known[nulls:].tolist()
        self.index = PerfectHash(
            np.array(row["levels"], np.int32),
            np.frombuffer(row["bits"], np.uint8),
            np.frombuffer(row["ranks"], "<u4").astype(np.int64),
        )
        self.prints = np.frombuffer(row["prints"], "<u4")
        self.slots = np.frombuffer(row["slots"], "<u4")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The first document of each key, -1 for keys that the shard does not have."""
        slot = self.index.slots(keys)
        known = (slot >= 0) & (slot < len(self.slots))
        out = np.full(len(keys), -1, np.int64)
        slot = slot[known]
        found = np.where(self.prints[slot] == _prints(keys[known]), self.slots[slot].astype(np.int64), -1)
        # a fingerprint can agree by chance, a key cannot
        own = np.array([self.keys[i] if i >= 0 else None for i in found], object)
        out[known] = np.where(own == keys[known], found, -1)
        return out

    def document(self, place: int) -> np.ndarray:
        return self.ids[self.starts[place] : self.starts[place + 1]]


def read_shards(df: DataFrame, path: str) -> DataFrame:
    return df.sparkSession.read.schema(SCHEMA).parquet(path)


def lookup(shards: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``(key, ids)`` of every document with one of the keys, through the indexes.

    Keys go to the shards whose range of keys they lie in; no shard is scanned for them.
    """
    wanted = keys.select(F.col(key).cast("bigint").alias("key")).filter("key IS NOT NULL").distinct()
    ranges = shards.select("shard", "least", "greatest")
    asked = (
        wanted.join(ranges, F.col("key").between(F.col("least"), F.col("greatest")))
        .groupBy("shard")
        .agg(F.collect_list("key").alias("wanted"))
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
                shard = Shard(row)
                names, ids = [], []
                asked = np.array(row["wanted"], np.int64)
                for k, place in zip(asked.tolist(), shard.find(asked).tolist(), strict=True):
                    while 0 <= place < len(shard.keys) and shard.keys[place] == k:
                        names.append(k)
                        ids.append(shard.document(place).tolist())
                        place += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], ["key", "ids"]
                )

    rows = shards.join(asked, "shard").mapInArrow(found, "key bigint, ids array<bigint>")
    return rows.withColumnRenamed("key", key)


def documents_of(shards: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of every document, read from the shards.

    Each known key is found through its shard's index; rows with a NULL key follow their place.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # a row per shard
    offsets = shards.select("shard", "n_ids").withColumn(
        "offset", F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
                shard = Shard(row)
                known = np.array([k for k in shard.keys if k is not None], np.int64)
                nulls = len(shard.keys) - len(known)
                # repeated keys: the index gives the first, the others follow it
                distinct, at = np.unique(known, return_index=True)
                repeat = np.diff(np.append(at, len(known)))
                first = np.repeat(shard.find(distinct), repeat)
                place = np.concatenate([np.arange(nulls), first + np.arange(len(known)) - np.repeat(at, repeat)])
                place = place.astype(np.int64)
                start, end = shard.starts[place], shard.starts[place + 1]
                crc = [
                    zlib.crc32(shard.ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(start.tolist(), end.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(place), row["shard"])),
                        pa.array([shard.keys[i] for i in place], pa.int64()),
                        pa.array(start),
                        pa.array(end - start),
                        pa.array(crc, pa.int64()),
                    ],
                    ["shard", "key", "start", "n_tokens", "ids_crc32"],
                )

    schema = "shard bigint, key bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    rows = shards.mapInArrow(listed, schema)
    return rows.join(offsets.select("shard", "offset"), "shard").select(
        F.col("key").alias(key), (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(
    df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None
) -> DataFrame:
    """Write the shards of *df* to the shared folder and list every document from them."""
    path = run_folder(df.sparkSession, "token_shards")
    write_shards(df, path, key, text, tokenizer)
    return documents_of(read_shards(df, path), key)
