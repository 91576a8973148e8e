"""Near duplicates by SimHash fingerprints, joined through a binary trie.

The fingerprints are the leaves of a binary trie. The trie is joined with itself by
walking pairs of its nodes together: a pair of nodes carries the number of bits in
which their paths differ, and the walk leaves a pair as soon as that number exceeds
the allowed distance.

To share the walk out, the trie is built once for each of ``distance + 1`` rotations
of the bits. Two fingerprints within the distance agree on one whole block of bits,
so in one rotation they meet below the same node of that depth, and each such node is
walked by one task. A node with more fingerprints than a task should hold is not
walked but split: its fingerprints go on to the pairs of its descendants that are
still within the distance, as the walk itself would do, until every pair is small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.blocks import blocks
from martflow.llm.graph import components
from martflow.llm.tables import held, released
from martflow.sources.workdir import store

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
#: Fingerprints of one node pair that a task walks at once, and levels to descend beyond.
NODE_ROWS = 200_000
SPLIT_BITS = 4
_HASHED_AT_ONCE = 1 << 16
_PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text: words between white space, A-Z in lower case.

    Every shingle counts as often as it occurs. A text of fewer words is one shingle;
    one without words has fingerprint 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    width = min(shingle, len(found))
    starts, ends = (ends - sizes)[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), _HASHED_AT_ONCE):
        pairs = zip(starts[i : i + _HASHED_AT_ONCE], ends[i : i + _HASHED_AT_ONCE], strict=True)
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in pairs]
        cells = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(cells, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str, name: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Adds the fingerprint as a signed 64-bit number; NULL text counts as empty."""

    @F.arrow_udf("bigint")
    def marked(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.uint64)
        for first, offsets, data in blocks(texts):
            raw = data.tobytes()
            for i in range(len(offsets) - 1):
                out[first + i] = fingerprint(raw[offsets[i] : offsets[i + 1]], shingle)
        return pa.array(out.view(np.int64))

    return df.withColumn(name, marked(F.col(text)))


def _rotations(prints: DataFrame, distance: int) -> DataFrame:
    """Each fingerprint below its node of every rotation."""
    width = BITS // (distance + 1)

    def turned(i: int):
        by = i * width
        value = F.col("print")
        if by:
            value = F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, BITS - by))
        return F.struct(F.lit(i).alias("turn"), value.alias("path"))

    node = F.shiftrightunsigned("path", BITS - width)
    return (
        prints.select("print", F.explode(F.array(*map(turned, range(distance + 1)))).alias("x"))
        .select("print", "x.turn", "x.path")
        .select(
            "print", "turn", "path", F.lit(width).alias("depth"), node.alias("a"), node.alias("b"),
            F.lit(0).alias("differ"), F.lit(0).alias("side"),
        )
    )


_NODE = ["turn", "depth", "a", "b"]


def _descend(rows: DataFrame, distance: int, bits: int) -> DataFrame:
    """Rows of a node pair, passed on to all pairs of descendants within the distance."""
    mask = (1 << bits) - 1
    shifted = F.expr(f"shiftrightunsigned(path, {BITS} - depth - {bits})")
    below = rows.withColumn("own", shifted.bitwiseAND(F.lit(mask))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(mask).cast("bigint")))
    )
    below = below.withColumn(
        "differ", F.col("differ") + F.bit_count(F.col("own").bitwiseXOR(F.col("other")))
    ).filter(F.col("differ") <= distance)
    same = F.col("a") == F.col("b")
    # below one node, the smaller descendant is side 0
    side = F.when(same, (F.col("own") > F.col("other")).cast("int")).otherwise(F.col("side"))
    left = F.when(side == 0, F.col("own")).otherwise(F.col("other"))
    right = F.when(side == 0, F.col("other")).otherwise(F.col("own"))
    return below.select(
        "print", "turn", "path", (F.col("depth") + bits).alias("depth"),
        F.shiftleft("a", bits).bitwiseOR(left).alias("a"),
        F.shiftleft("b", bits).bitwiseOR(right).alias("b"),
        "differ", side.alias("side"),
    )


def walk(
    paths: np.ndarray, pairs: tuple[np.ndarray, ...], depth: int, distance: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within *distance* below pairs of trie nodes.

    A node is a range of *paths* (sorted within it) that agree on the first *depth*
    bits; *pairs* holds (first, end) of both nodes, whether they are the same node,
    and the bits in which their paths differ so far.
    """
    stack = [(depth, pairs)]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs[0]) > _PAIRS_AT_ONCE:
            half = len(pairs[0]) // 2
            stack += [(depth, tuple(x[half:] for x in pairs)), (depth, tuple(x[:half] for x in pairs))]
            continue
        a0, a1, b0, b1, same, differ = pairs
        ends = ~same & (a1 - a0 == 1) & (b1 - b0 == 1)
        if ends.any():
            i, j = a0[ends], b0[ends]
            near = np.bitwise_count(paths[i] ^ paths[j]) <= distance
            yield i[near], j[near]
        go = ~ends & ~(same & (a1 - a0 == 1))
        a0, a1, b0, b1, same, differ = (x[go] for x in pairs)
        if not len(a0) or depth == BITS:
            continue
        ones = np.zeros(len(paths) + 1, np.int64)
        np.cumsum((paths >> np.uint64(BITS - 1 - depth)) & np.uint64(1), out=ones[1:])
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        two = ~same
        below = [
            (a0, am, b0, bm, same, differ),
            (am, a1, bm, b1, same, differ),
            (a0, am, bm, b1, np.zeros_like(same), differ + 1),
            tuple(x[two] for x in (am, a1, b0, bm, same, differ + 1)),
        ]
        pairs = tuple(np.concatenate(x) for x in zip(*below, strict=True))
        full = (pairs[1] > pairs[0]) & (pairs[3] > pairs[2]) & (pairs[5] <= distance)
        stack.append((depth + 1, tuple(x[full] for x in pairs)))


def _least_linked(count: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of *count* rows the least row it is linked to, directly or not."""
    least = np.arange(count)
    if not links:
        return least
    i, j = (np.concatenate(x) for x in zip(*links, strict=True))
    while True:
        before = least.copy()
        low = np.minimum(least[i], least[j])
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        least = least[least]
        if (least == before).all():
            return least


def _walked(table: pa.Table, distance: int) -> pa.Table:
    """Links below the node pairs of a table that holds each of them whole and in order."""
    col = {n: table.column(n).to_numpy() for n in table.column_names}
    new = np.ones(len(table), bool)
    new[1:] = np.any([col[n][1:] != col[n][:-1] for n in _NODE], axis=0)
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(table))
    ones = np.concatenate([[0], np.cumsum(col["side"])])
    middle = end - (ones[end] - ones[first])
    same = col["a"][first] == col["b"][first]
    middle = np.where(same, end, middle)
    pairs = (first, middle, np.where(same, first, middle), end, same, col["differ"][first])
    full = (pairs[1] > pairs[0]) & (pairs[3] > pairs[2])
    paths, depth, links = col["path"].view(np.uint64), col["depth"][first], []
    for d in np.unique(depth[full]):
        chosen = tuple(x[full & (depth == d)] for x in pairs)
        links += walk(paths, chosen, int(d), distance)
    least = _least_linked(len(table), links)
    linked = least != np.arange(len(table))
    prints = col["print"]
    return pa.table({"a": prints[linked], "b": prints[least[linked]]})


def _walk_batches(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < NODE_ROWS:
            continue
        table = pa.Table.from_batches(held)
        last = [table.column(n)[len(table) - 1].as_py() for n in _NODE]
        other = np.any(
            [table.column(n).to_numpy() != x for n, x in zip(_NODE, last, strict=True)], axis=0
        )
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if cut:
            yield from _walked(table.slice(0, cut), distance).to_batches()
        held = table.slice(cut).to_batches()
    if held:
        yield from _walked(pa.Table.from_batches(held), distance).to_batches()


def near_links(
    prints: DataFrame, distance: int = MAX_DISTANCE, node_rows: int = NODE_ROWS
) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints of column ``print``.

    They connect all fingerprints within the distance, directly or through others:
    each walked node pair gives a link from every member of a group to one of them.
    """
    rows, small = store(_rotations(prints, distance), "nodes"), []
    while True:
        sizes = rows.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("size"))
        large = sizes.filter((F.col("size") > node_rows) & (F.col("depth") < BITS)).drop("size")
        large = store(large, "large_nodes")
        if large.isEmpty():
            small.append(rows)
            break
        small.append(rows.join(large, _NODE, "left_anti"))
        hot = rows.join(large, _NODE, "left_semi")
        step = SPLIT_BITS if hot.agg(F.max("depth")).first()[0] <= BITS - SPLIT_BITS else 1
        rows = store(_descend(hot, distance, step), "nodes")
    out = []
    for part in small:
        # paths are unsigned: with the top bit turned over, signed order is their order
        dealt = (
            part.withColumn("order", F.col("path").bitwiseXOR(F.lit(-(1 << 63))))
            .repartition(*_NODE)
            .sortWithinPartitions(*_NODE, "side", "order")
        )
        out.append(
            dealt.mapInArrow(lambda it: _walk_batches(it, distance), "a bigint, b bigint").distinct()
        )
    links = out[0]
    for more in out[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``(key, fingerprint, component_id)``, a row for each row of *df*.

    Two rows are linked if their fingerprints differ in at most *distance* bits;
    ``component_id`` is the least key reachable over links. Equal fingerprints, from
    repeated rows or not, are one node. NULL and empty texts have fingerprint zero and are linked
    like any other; a NULL key is passed over when the least is taken, so a group in
    which all keys are NULL has a NULL component. Other columns are not looked at.
    """
    marked = with_fingerprint(
        df.select(F.col(key).alias("key"), F.col(text).alias("text")), "text", "print", shingle
    )
    marked = store(marked.select("key", "print"), "prints")
    nodes = store(marked.groupBy("print").agg(F.min("key").alias("least")), "print_nodes")
    roots = components(near_links(nodes, distance), "a", "b")
    nodes = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "root").select("print", "component_id")
    return marked.join(named, "print").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """The rows of *df*, all columns, that are the first of their group of near duplicates.

    First is the least key, then the least hash of the text; NULL keys come last. Of rows
    that agree in key and text one stays. Groups are those of :func:`near_duplicates`. A NULL text
    is the empty one. Other columns may have any names.
    """
    own = ["none", "key", "mark"]
    value = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).isNull().alias("none"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("key"),
        F.xxhash64(value).alias("mark"),
        held(df).alias("held"),
    )
    texts = df.select(
        F.col(key).isNull().alias("none"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("key"),
        F.xxhash64(value).alias("mark"),
        value.alias("text"),
    )
    marked = with_fingerprint(texts, "text", "print", shingle)
    marked = store(marked.select(F.struct(*own).alias("row"), "print"), "prints")
    nodes = store(marked.groupBy("print").agg(F.min("row").alias("least")), "print_nodes")
    roots = components(near_links(nodes, distance), "a", "b")
    first = (
        nodes.join(roots.withColumnRenamed("node", "print"), "print", "left")
        .groupBy(F.coalesce("root", "print").alias("root"))
        .agg(F.min("least").alias("row"))
        .select("row.*")
    )
    kept = rows.join(first, own, "left_semi").dropDuplicates(own)
    return kept.select(*released(df, "held"))
