"""Repair of conversation structure at least cost, by a square-root checkpointed recurrence.

The repaired roles are an optional ``system`` and then pairs of ``user`` and ``assistant``. With the rows
of a conversation in order, the cost of mending the rest depends on the state alone (nothing yet, after
system, after user, after assistant), so four numbers stand between any two rows. They are computed
backwards and kept only at checkpoints, every square root of the rows; walking forward, the rows
between two checkpoints are computed again, and each step takes the ASCII-least edit that keeps the cost.

Conversations are not brought to one task for this. Rows are sorted by range over the cluster and
cut into blocks of at most the square root of all rows. A conversation within one block is mended there.
For the others each block gives the 4 x 4 costs from state to state; a chain over a conversation's
blocks turns them into the costs at the end of each, with which every block is walked from all four
states at once, and a second chain picks the walks that join. Faults that look back, such as a text seen
earlier, come from groupings by digest, so that only 32 bytes stand for a text until it is written.

Rows that agree in all of conversation, turn, role and text are counted, not kept apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.llm.tables import store

#: Rows of a block, unless the square root of all rows is more.
LEAST_BLOCK = 1024

# fixed values: spaces, ends of sentences, costs of the edits, roles and the pairs they may form
_WORD = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
LEGAL = ("su", "ua", "au")

# states: nothing yet, and after system, user, assistant
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state after a user or assistant, whichever may follow.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
#: By initial: the state after a row that is kept, from each state, or -1.
_KEPT = {
    "s": (_SYSTEM, -1, -1, -1),
    "u": (_USER, _USER, -1, _USER),
    "a": (-1, -1, _ASSISTANT, -1),
}
_NEVER = (-1, -1, -1, -1)
#: What is left to pay after the last row.
_END = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 50

#: A row as the recurrence sees it: None if it must go, else where it leads and what keeping it costs.
Code = tuple[tuple[int, ...], int] | None
Costs = tuple[int, ...]


# --- the recurrence --------------------------------------------------------------


def code(role: str, forced: bool, truncated: bool) -> Code:
    return None if forced else (_KEPT.get(role[:1], _NEVER), TRUNCATED * truncated)


def before(row: Code, after: Costs) -> Costs:
    """Least costs from each state before a row, with those after it."""
    costs = [DELETE + x for x in after]
    if row is not None:
        kept, late = row
        for state in range(4):
            costs[state] = min(costs[state], REROLE + late + after[_NEXT[state]])
            if kept[state] >= 0:
                costs[state] = min(costs[state], late + after[kept[state]])
    user, assistant = costs[_USER], costs[_ASSISTANT]
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    first = INSERT + user
    return min(costs[_NOTHING], first), min(costs[_SYSTEM], first), user, assistant


def between(rows: list[Code]) -> list[Costs]:
    """Costs through all rows, by the state after and the state before them."""
    found = []
    for state in range(4):
        costs: Costs = tuple(0 if s == state else _FAR for s in range(4))
        for row in reversed(rows):
            costs = before(row, costs)
        found.append(costs)
    return found


def walk(rows: list[Code], after: Costs, state: int, last: bool) -> tuple[list[str], int, int]:
    """The edits of each row, the state after all and the cost.

    Edits are letters: ``u`` and ``a`` insert a user or assistant, ``U`` and ``A`` make the row one, ``K``
    keeps and ``D`` deletes it. *last* adds what completes the conversation to its last row.
    """
    step = isqrt(len(rows)) + 1
    marks = {len(rows): after}
    costs = after
    for i in range(len(rows) - 1, -1, -1):
        costs = before(rows[i], costs)
        if i % step == 0:
            marks[i] = costs
    found, paid = [], 0
    for start in range(0, len(rows), step):
        end = min(start + step, len(rows))
        vectors = [marks[end]]
        for i in range(end - 1, start - 1, -1):
            vectors.append(before(rows[i], vectors[-1]))
        vectors.reverse()
        for i in range(start, end):
            edits, state, cost = _edit(rows[i], vectors[i - start], vectors[i - start + 1], state)
            found.append(edits)
            paid += cost
    while last and state not in (_NOTHING, _ASSISTANT):
        found[-1] += _inserted(state)
        state, paid = _NEXT[state], paid + INSERT
    return found, state, paid


def _inserted(state: int) -> str:
    return "a" if state == _USER else "u"


def _edit(row: Code, here: Costs, after: Costs, state: int) -> tuple[str, int, int]:
    """Edits up to and including one row, ASCII-least by name: delete, insert, keep, rerole."""
    edits, paid = "", 0
    while True:
        if DELETE + after[state] == here[state]:
            return edits + "D", state, paid + DELETE
        if INSERT + here[_NEXT[state]] == here[state]:
            edits, paid, state = edits + _inserted(state), paid + INSERT, _NEXT[state]
            continue
        kept, late = row
        if kept[state] >= 0 and late + after[kept[state]] == here[state]:
            return edits + "K", kept[state], paid + late
        return edits + _inserted(state).upper(), _NEXT[state], paid + REROLE + late


# --- faults ----------------------------------------------------------------------


def turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows under the operator's own names; a NULL role or text is one space."""
    return df.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumn("mark", F.unhex(F.sha2("text", 256)))


def faults(rows: DataFrame) -> DataFrame:
    """Stored distinct rows without their texts: copies, whether blank, truncated, and the first of its kind.

    Both groupings combine in the map tasks; the join is on all that tells a row, so that it is even.
    """
    marked = rows.select(
        "conv", "turn", "role", "mark",
        (~F.col("text").rlike(_WORD)).alias("blank"), (~F.col("text").rlike(_ENDED)).alias("truncated"),
    )
    runs = marked.groupBy("conv", "turn", "role", "mark", "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = (
        marked.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"))
        .agg(F.min(place).alias("place"))
        .select("c", "r", "m", F.col("place.turn").alias("t"), F.lit(True).alias("first"))
    )
    same = (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    same = same & F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
    joined = runs.join(firsts, same, "left").drop("c", "r", "m", "t")
    return store(joined.withColumn("first", F.coalesce("first", F.lit(False))), "turns")


# --- blocks ----------------------------------------------------------------------


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        names = batch.schema.names
        for values in zip(*columns, strict=True):
            yield dict(zip(names, values, strict=True))


def _by_conversation(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[list[dict], bool]]:
    """Consecutive rows of one conversation, *limit* at most, and whether they are all of it that is here."""
    held: list[dict] = []
    whole = True
    for row in _rows(batches):
        if held and (row["conv"] != held[0]["conv"] or len(held) == limit):
            goes_on = row["conv"] == held[0]["conv"]
            yield held, whole and not goes_on
            held, whole = [], not goes_on
        held.append(row)
    if held:
        yield held, whole


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _codes(rows: list[dict]) -> list[Code]:
    return [code(r["role"], r["blank"] or not r["first"], r["truncated"]) for r in rows]


def _with_copies(edits: list[str], copies: list[int]) -> list[str]:
    """A deletion for every further copy of a row, before what is inserted after the row."""
    return [
        e if n == 1 else e[: len(e.rstrip("ua"))] + "D" * (n - 1) + e[len(e.rstrip("ua")) :]
        for e, n in zip(edits, copies, strict=True)
    ]


def _placed(edits: list[str]) -> dict:
    """The edits, and the place that the first remaining row of each has in its block."""
    ends = list(accumulate(len(e) - e.count("D") for e in edits))
    return {"plans": edits, "places": [0, *ends[:-1]], "size": ends[-1]}


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def blocks(runs: DataFrame, size: int) -> DataFrame:
    """Stored blocks of *size* rows at most, in the order of ``part`` and ``no``.

    A block that is a whole conversation has its ``plans``, the edits of each of its rows. The others are
    ``open``: they have the costs from state to state, ``across``.
    """
    kinds = {f.name: f.dataType for f in runs.schema.fields}
    text, number, truth = T.StringType(), T.LongType(), T.BooleanType()
    schema = _fields(
        conv=kinds["conv"], part=T.IntegerType(), no=T.IntegerType(), open=truth, turns=T.ArrayType(kinds["turn"]),
        roles=T.ArrayType(text), marks=T.ArrayType(T.BinaryType()), forced=T.ArrayType(truth),
        late=T.ArrayType(truth), copies=T.ArrayType(number), plans=T.ArrayType(text), places=T.ArrayType(number),
        size=number, across=T.ArrayType(number),
        n_blank=number, n_duplicate=number, n_truncated=number, n_illegal=number, cost=number,
    )

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, arrow = TaskContext.get().partitionId(), None

        def typed(batches):
            nonlocal arrow
            for batch in batches:
                arrow = arrow or _arrow(schema, batch.schema)
                yield batch

        ready: list[dict] = []
        weight = 0
        groups = _by_conversation(typed(batches), size)
        held = next(groups, None)
        no = 0
        while held:
            rows, whole = held
            held = next(groups, None)
            # the first and the last conversation of a part may have rows in another
            closed = whole and no > 0 and held is not None
            ready.append(_block(rows, part, no, closed))
            weight += len(rows)
            no += 1
            if weight >= 4 * LEAST_BLOCK:
                yield _batch(ready, arrow)
                ready, weight = [], 0
        if ready:
            yield _batch(ready, arrow)

    order = ("conv", "turn", "role", "mark")
    sorted_ = runs.repartitionByRange(*order).sortWithinPartitions(*order)
    return store(sorted_.mapInArrow(build, schema), "blocks")


def _arrow(schema: T.StructType, given: pa.Schema) -> pa.Schema:
    """Arrow types of a block; those of conversation and turn are as they came."""
    fixed = {
        T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(),
        T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary(),
    }
    fields = []
    for field in schema.fields:
        if field.name == "conv":
            kind = given.field("conv").type
        elif field.name == "turns":
            kind = pa.list_(given.field("turn").type)
        elif isinstance(field.dataType, T.ArrayType):
            kind = pa.list_(fixed[field.dataType.elementType])
        else:
            kind = fixed[field.dataType]
        fields.append(pa.field(field.name, kind))
    return pa.schema(fields)


def _block(rows: list[dict], part: int, no: int, closed: bool) -> dict:
    found = _codes(rows)
    roles, copies = [r["role"] for r in rows], [r["copies"] for r in rows]
    same = sum((n - 1) * (r[:1] * 2 not in LEGAL) for r, n in zip(roles, copies, strict=True))
    block = {
        "conv": rows[0]["conv"],
        "part": part,
        "no": no,
        "open": not closed,
        "turns": [r["turn"] for r in rows],
        "roles": roles,
        "marks": [r["mark"] for r in rows],
        "forced": [x is None for x in found],
        "late": [r["truncated"] for r in rows],
        "copies": copies,
        "n_blank": sum(r["copies"] for r in rows if r["blank"]),
        "n_duplicate": sum(r["copies"] - r["first"] for r in rows if not r["blank"]),
        "n_truncated": sum(r["truncated"] for r in rows if r["first"] and not r["blank"]),
        "n_illegal": same + _illegal(roles),
        "plans": [],
        "places": [],
        "size": 0,
        "across": [],
        "cost": DELETE * (sum(copies) - len(copies)),
    }
    if closed:
        edits, _, cost = walk(found, _END, _NOTHING, True)
        block["cost"] += cost
        block |= _placed(_with_copies(edits, copies))
    else:
        block["across"] = [x for costs in between(found) for x in costs]
    return block


# --- conversations of several blocks ----------------------------------------------


def _chained(df: DataFrame, chain: Callable[[list[dict]], Iterator[dict]], schema: T.StructType) -> DataFrame:
    """*chain* over the blocks of each conversation in order; at most the square root of all rows
    and one block per part belong to a conversation."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"IntegerType()": pa.int32(), "LongType()": pa.int64(), "BooleanType()": pa.bool_()}
        arrow = pa.schema(
            [
                (f.name, pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else kinds[str(f.dataType)])
                for f in schema.fields
            ]
        )
        for rows, _ in _by_conversation(batches, 1 << 62):
            yield _batch(list(chain(rows)), arrow)

    return df.repartition("conv").sortWithinPartitions("conv", "part", "no").mapInArrow(run, schema)


def _backward(rows: list[dict]) -> Iterator[dict]:
    """The costs at the end of each block, and illegal neighbours across its beginning."""
    after, found = _END, []
    for i in range(len(rows) - 1, -1, -1):
        border = i > 0 and rows[i - 1]["last_role"][:1] + rows[i]["first_role"][:1] not in LEGAL
        found.append(
            {"part": rows[i]["part"], "no": rows[i]["no"], "after": list(after), "last": i == len(rows) - 1, "border": int(border)}
        )
        across = rows[i]["across"]
        after = tuple(min(across[4 * t + s] + after[t] for t in range(4)) for s in range(4))
    yield from found


def _forward(rows: list[dict]) -> Iterator[dict]:
    """The state in which each block begins."""
    state = _NOTHING
    for row in rows:
        yield {"part": row["part"], "no": row["no"], "start": state}
        state = row["ends"][state]


def _walks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = pa.schema(
        [("part", pa.int32()), ("no", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
         ("plans", pa.list_(pa.string())), ("places", pa.list_(pa.int64())), ("size", pa.int64()), ("paid", pa.int64())]
    )
    for row in _rows(batches):
        found = [
            code(r, f, t) for r, f, t in zip(row["roles"], row["forced"], row["late"], strict=True)
        ]
        ways = []
        for start in range(4):
            edits, end, cost = walk(found, tuple(row["after"]), start, row["last"])
            way = {"part": row["part"], "no": row["no"], "start": start, "end": end, "paid": cost}
            ways.append(way | _placed(_with_copies(edits, row["copies"])))
        yield _batch(ways, arrow)


def plans(runs: DataFrame, least_block: int = LEAST_BLOCK) -> DataFrame:
    """Blocks with the edits of all their rows, of all conversations."""
    cut = blocks(runs, max(least_block, isqrt(runs.count())))
    kept = [c for c in cut.columns if c not in ("open", "across", "forced", "late")]
    done = cut.filter(~F.col("open")).select(*kept)
    open_ = cut.filter("open")
    whole, number = T.IntegerType(), T.LongType()
    ends = open_.select(
        "conv", "part", "no", "across", F.get("roles", F.lit(0)).alias("first_role"),
        F.element_at("roles", -1).alias("last_role"),
    )
    schema = _fields(part=whole, no=whole, after=T.ArrayType(number), last=T.BooleanType(), border=number)
    after = store(_chained(ends, _backward, schema), "after")
    ways = store(
        open_.join(after, ["part", "no"])
        .select("part", "no", "roles", "forced", "late", "copies", "after", "last")
        .mapInArrow(
            _walks,
            _fields(
                part=whole, no=whole, start=whole, end=whole, plans=T.ArrayType(T.StringType()),
                places=T.ArrayType(number), size=number, paid=number,
            ),
        ),
        "walks",
    )
    by_start = ways.groupBy("part", "no").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("start", "end"))), lambda x: x["end"]).alias("ends")
    )
    starts = _chained(
        open_.select("conv", "part", "no").join(by_start, ["part", "no"]), _forward, _fields(part=whole, no=whole, start=whole)
    )
    chosen = ways.join(starts, ["part", "no", "start"]).select("part", "no", "plans", "places", "size", "paid")
    mended = open_.drop("plans", "places", "size").join(chosen, ["part", "no"]).join(after.select("part", "no", "border"), ["part", "no"])
    mended = mended.withColumns(
        {"cost": F.col("cost") + F.col("paid"), "n_illegal": F.col("n_illegal") + F.col("border")}
    )
    return done.unionByName(mended.select(*kept))


# --- results ---------------------------------------------------------------------


def audit(runs: DataFrame, planned: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, the cost and initials of its edits."""
    letters = F.translate(F.array_join("plans", ""), "uaUA", "IIRR")
    totals = planned.groupBy("conv").agg(
        *[F.sum(f"n_{c}").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.sum("cost").alias("cost"),
        F.sort_array(F.collect_list(F.struct("part", "no", letters.alias("letters")))).alias("pieces"),
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = runs.groupBy(F.col("conv").alias("c")).agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"))
    joined = totals.join(gaps, F.col("conv").eqNullSafe(F.col("c")))
    return joined.select(
        "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join(F.transform("pieces", lambda x: x["letters"]), "").alias("audit"),
    )


def _applied(rows: DataFrame, planned: DataFrame, *by: str) -> DataFrame:
    """``(conv, at, role, text, edit)`` of all rows that remain, partitioned by the columns *by*.

    The edits of a row are sorted to stand right before its text; a task holds one row at a time.
    """
    own = Window.partitionBy("conv").orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    # a window over the blocks of a conversation: few, and without texts
    sizes = planned.select("conv", "part", "no", F.coalesce(F.sum("size").over(own), F.lit(0)).alias("offset"))
    steps = F.arrays_zip(
        F.col("turns").alias("turn"), F.col("roles").alias("role"), F.col("marks").alias("mark"),
        F.col("plans").alias("plan"), F.col("places").alias("place"),
    )
    edits = (
        planned.select("conv", "part", "no", F.inline(steps))
        .join(sizes.drop("conv"), ["part", "no"])
        .select("conv", "turn", "role", "mark", "plan", (F.col("offset") + F.col("place")).alias("at"), F.lit(None).cast("string").alias("text"))
    )
    texts = rows.select(
        "conv", "turn", "role", "mark", F.lit(None).cast("string").alias("plan"), F.lit(None).cast("bigint").alias("at"), "text"
    )
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    text = T.StringType()
    schema = _fields(conv=kinds["conv"], at=T.LongType(), role=text, text=text, edit=text)
    order = ("conv", "turn", "role", "mark")
    both = edits.unionByName(texts).repartition(*by).sortWithinPartitions(*order, F.col("at").isNull())
    return both.mapInArrow(_apply, schema)


def _apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plan, at = "", 0
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("conv", "role", "plan", "at", "text")]
        for conv, role, told, place, text in zip(*(c.to_pylist() for c in columns), strict=True):
            if told is not None:
                plan, at = told, place
                continue
            for edit in plan.replace("D", ""):
                now = {"K": role, "U": USER, "u": USER, "A": ASSISTANT, "a": ASSISTANT}[edit]
                name = "I" if edit in "ua" else "K" if edit == "K" else "R"
                out.append((conv, at, now, "" if name == "I" else text, name))
                at += 1
            plan = ""
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv", "at", "role", "text", "edit"])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, conv, digest = None, None, None
    for batch in batches:
        kind, done = batch.schema.field("conv").type, []
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv", "role", "text")]
        for own, role, text in zip(*columns, strict=True):
            if digest is None or own != conv:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = own, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield _digested(done, kind)
    if digest is not None:
        yield _digested([(conv, digest.hexdigest())], kind)


def _digested(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    convs, digests = zip(*done, strict=True) if done else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(digests, pa.string())], names=["conv", "digest"])


class Repair:
    """What mending a table of conversations gives, all as tables by conversation.

    Rows are in the order of their turns, NULL first; rows of one turn come by role and then by the SHA-256 digest
    of their text. NULL roles and texts are one space. A NULL conversation is one like any other.
    Repeated rows are duplicates of the first. Other columns of the table are left out, whatever their names; an empty table
    has no conversations.
    """

    def __init__(
        self,
        df: DataFrame,
        conv: str = "conv_id",
        turn: str = "turn",
        role: str = "role",
        text: str = "text",
        least_block: int = LEAST_BLOCK,
    ):
        self.conv = conv
        self.rows = turns(df, conv, turn, role, text)
        self.runs = faults(self.rows)
        self.plans = plans(self.runs, least_block)

    def audit(self) -> DataFrame:
        """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)``: turns that are missing,
        rows by their first fault, neighbours out of order, and the cheapest edits with their cost."""
        return audit(self.runs, self.plans).withColumnRenamed("conv", self.conv)

    def repaired(self) -> DataFrame:
        """``(conv, at, role, text, edit)``: the rows that remain, numbered from 0, and how each came about:
        K as it was, R with another role, I inserted. A conversation is spread over tasks like all rows."""
        by = ("conv", "turn", "role", "mark")
        return _applied(self.rows, self.plans, *by).withColumnRenamed("conv", self.conv)

    def digests(self) -> DataFrame:
        """``(conv, digest)``: SHA-256 of ``role:text`` of the remaining rows, newline-joined, where any remain.

        Such a digest is made in sequence, so a task passes over the rows of a conversation, one at a time.
        """
        schema = _fields(conv=self.rows.schema["conv"].dataType, digest=T.StringType())
        return _applied(self.rows, self.plans, "conv").mapInArrow(_digests, schema).withColumnRenamed("conv", self.conv)
