"""Quality classifier: hashed word and character n-gram vectors, averaged, softmax.

Every feature of a text (words, pairs of neighbouring words, character n-grams) has a
learned vector in a hashed table. A text is the mean of the vectors of all its features,
and a softmax layer over the mean gives the probability of each label. Vectors and
layer are learned together by stochastic gradient descent in numpy.

The model is fitted on at most ``ROWS_PER_LABEL`` labelled texts of each label, taken
in the order of a hash of their key; that bound is what keeps fitting on the driver.
Scoring covers all rows, in their own tasks, without a shuffle: the product of table
and layer is one number per feature and label.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.blocks import blocks, scatter, words

BUCKET_BITS = 17
DIMENSIONS = 8
#: Lengths of character n-grams, in UTF-8 bytes.
CHARS = (3, 4)
ROWS_PER_LABEL = 1500
EPOCHS = 4
RATE = 0.5
#: Features take some 100 bytes per byte of text while they are made, so blocks are small.
BLOCK_BYTES = 1 << 18
#: Word bytes are told apart by white space alone; case is kept, as it tells quality.
_BYTES = np.array([0 if x == 32 or 9 <= x <= 13 else x for x in range(256)], np.uint8)
_REPEAT = np.uint64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Model:
    """``weight``: a feature's part in the logit of label 1 against label 0."""

    weight: np.ndarray
    bias: float


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature its buckets in text order, and the offsets of the texts in them."""
    starts, _, own = words(data, offsets, _BYTES)
    at = np.searchsorted(starts, offsets)
    out = [(_buckets(own), at)]
    # a word after itself is one feature, whatever the word
    same = own[1:] == own[:-1]
    pair = scatter(own[:-1] * np.uint64(0xD6E8FEB86659FD93) + own[1:])
    pair[same] = _REPEAT
    # a pair belongs to the text of its first word; the last word of a text has none
    last = np.zeros(len(own) + 1, bool)
    last[at[1:] - 1] = True  # texts without words mark a place that has no pair of its own text
    within = ~last[: len(pair)]
    kept = np.concatenate([[0], np.cumsum(within)])
    out.append((_buckets(pair[within]), kept[np.minimum(at, len(pair))]))
    wide = data.astype(np.uint64)
    for n in CHARS:
        whole = max(0, len(data) - n + 1)
        gram = np.full(whole, n, np.uint64)
        for k in range(n):
            gram = (gram << np.uint64(8)) | wide[k : k + whole]
        gram = gram * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
        gram *= np.uint64(0xBF58476D1CE4E5B9)
        # n-grams that run over the end of their text are left out
        cut = np.zeros(whole + n, bool)
        for k in range(1, n):
            cut[np.maximum(offsets[1:] - k, 0)] = True
        within = ~cut[:whole]
        kept = np.concatenate([[0], np.cumsum(within)])
        out.append((_buckets(gram[within]), kept[np.minimum(offsets, whole)]))
    return out


def _examples(df: DataFrame, text: str, label: str) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(distinct buckets, their share of the text's features, label) of each row."""

    @F.arrow_udf("struct<bucket:binary,share:binary>")
    def counted(texts: pa.Array) -> pa.Array:
        found = []
        for _, offsets, data in blocks(texts, BLOCK_BYTES):
            kinds = features(data, offsets)
            for i in range(len(offsets) - 1):
                own = np.concatenate([x[at[i] : at[i + 1]] for x, at in kinds])
                bucket, count = np.unique(own, return_counts=True)
                share = (count / max(1, len(own))).astype(np.float32)
                found.append({"bucket": bucket.astype("<i4").tobytes(), "share": share.tobytes()})
        return pa.array(found, pa.struct([("bucket", pa.binary()), ("share", pa.binary())]))

    rows = df.select(F.col(label).alias("y"), counted(F.col(text)).alias("x"))
    return [
        (np.frombuffer(r["x"]["bucket"], "<i4"), np.frombuffer(r["x"]["share"], np.float32), r["y"])
        for r in rows.collect()
    ]


def _ordered(examples: list[tuple[np.ndarray, np.ndarray, int]]) -> list:
    """By label, number of buckets, buckets and shares; only those that tie on the numbers have their bytes copied."""

    def numbers(x):
        return x[2], len(x[0])

    ties = groupby(sorted(examples, key=numbers), numbers)
    return [x for _, tie in ties for x in sorted(tie, key=lambda x: (x[0].tobytes(), x[1].tobytes()))]


def learn(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Gradient descent, one text at a time, with a rate that falls to nothing.

    The result depends on the set of examples only, not on their order. Without
    examples of both labels every text scores 0, 1 or, without any, one half.
    """
    labels = {y for *_, y in examples}
    if labels != {0, 1}:
        only = 0.0 if not labels else 50.0 if labels == {1} else -50.0
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), only)
    examples = _ordered(examples)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    layer += rng.normal(0, 0.1, layer.shape).astype(np.float32)
    done, total = 0, EPOCHS * len(examples)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            bucket, share, y = examples[i]
            rate = np.float32(RATE * (1 - done / total))
            mean = share @ table[bucket]
            logits = mean @ layer + bias
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[y] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            bias -= rate * error
            # shares are small: rows are stepped by their share of the largest one
            step = share / max(float(share.max(initial=0)), 1e-9)
            table[bucket] -= rate * np.outer(step, back)
            done += 1
    side = layer[:, 1] - layer[:, 0]
    return Model((table @ side).astype(np.float32), float(bias[1] - bias[0]))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows_per_label: int = ROWS_PER_LABEL,
) -> Model:
    """Learn from labelled rows, at most *rows_per_label* of each label.

    Labels other than 0 and 1, and NULL keys, are passed over. Of the rows that share a key, and of
    repeated labels, one is learned from: that with the least hash of its text.
    """
    chosen = None
    for value in (0, 1):
        part = (
            labels.filter(F.col(label) == value)
            .select(F.col(key).alias("k"), F.lit(value).alias("y"))
            .filter("k IS NOT NULL")
            .orderBy(F.xxhash64("k"), "k")
            .limit(rows_per_label)
        )
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * rows_per_label rows, by the limits above
    texts = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = texts.join(F.broadcast(chosen), "k")
    one = rows.groupBy("k", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    return learn(_examples(one.orderBy("k", "y"), "t", "y"))


def scores(texts: pa.Array, weight: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(texts))
    for first, offsets, data in blocks(texts, BLOCK_BYTES):
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for bucket, at in features(data, offsets):
            sums = np.concatenate([[0], np.cumsum(weight[bucket], dtype=np.float64)])
            total += sums[at[1:]] - sums[at[:-1]]
            count += at[1:] - at[:-1]
        logit = total / np.maximum(count, 1) + bias
        out[first : first + len(logit)] = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
    return out


def with_score(df: DataFrame, model: Model, text: str, name: str) -> DataFrame:
    """Adds the probability of label 1. All of a text counts; NULL counts as empty, and an
    empty text, having no features, scores by the layer's bias alone."""
    weight, bias = model.weight, model.bias

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(scores(texts, weight, bias))

    return df.withColumn(name, scored(F.col(text)))


def held_out(key):
    """Rows that are never learned from: one in three, by the checksum of the key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, held_out, score, predicted)``, a row for each row of *documents*.

    ``predicted`` is 1 where the score is at least one half. A row with a NULL key is
    scored and not held out, but never learned from. Labels of keys that occur repeatedly
    count once. Without labels every score is one half.
    """
    model = fit(documents, labels.filter(~held_out(F.col(key))), key, text)
    plain = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return with_score(plain, model, "t", "score").select(
        F.col("k").alias(key),
        held_out(F.col("k")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
