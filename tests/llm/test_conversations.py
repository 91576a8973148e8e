"""Conversation repair against a plain search over all edits, in one block and in many, and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from martflow.llm import conversations, queries

_MOVES = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
_ROLES = (("u", "user"), ("a", "assistant"))


def _mended(rows):
    """Least (cost, audit) that reaches each state after each row, by trying every edit; rows: (turn, role, text)."""
    faults, seen = [], set()
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    best = {"0": (0, "", ())}

    def reach(found, state, way):
        if state and (state not in found or way[:2] < found[state][:2]):
            found[state] = way
            return True
        return False

    def inserted(found):
        todo = list(found)
        while todo:
            state = todo.pop()
            cost, audit, out = found[state]
            for initial, name in _ROLES:
                to = _MOVES.get((state, initial))
                if reach(found, to, (cost + 3, audit + "I", (*out, (name, "")))):
                    todo.append(to)
        return found

    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, out) in inserted(best).items():
            reach(after, state, (cost + 4, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                reach(after, _MOVES.get((state, role[:1])), (cost + late, audit + "K", (*out, (role, text))))
                for initial, name in _ROLES:
                    reach(after, _MOVES.get((state, initial)), (cost + late + 3, audit + "R", (*out, (name, text))))
        best = after
    cost, audit, out = min(w for s, w in inserted(best).items() if s in "0a")
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    counts = tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
    return (gaps, *counts, illegal, cost, audit), out


def _ordered(rows):
    def place(r):
        turn, role, text = r
        return (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())

    return sorted(rows, key=place)


def _by_conversation(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: _ordered(r) for conv, r in by.items()}


def _sha(out):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def _check(repair, rows):
    wanted = {conv: _mended(r) for conv, r in _by_conversation(rows).items()}
    found = {r[0]: tuple(r)[1:] for r in repair.audit().collect()}
    assert found == {conv: w for conv, (w, _) in wanted.items()}
    assert {r[0]: r[1] for r in repair.digests().collect()} == {c: _sha(out) for c, (_, out) in wanted.items() if out}
    kept = collections.defaultdict(list)
    for conv, at, role, text, edit in sorted((tuple(r) for r in repair.repaired().collect()), key=lambda r: r[1]):
        assert at == len(kept[conv])
        kept[conv].append((role, text))
        assert edit in "KRI"
    assert {c: tuple(k) for c, k in kept.items()} == {c: out for c, (_, out) in wanted.items() if out}


SCHEMA = "conv_id bigint, turn bigint, role string, text string"
ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", "unknown", None]
TEXTS = ["Yes.", "No!", "Why?", "Because", "so  ", "", " \t\n", "Hm...", "É. \n", None]


def _random_rows(seed, convs, turns):
    rng = np.random.default_rng(seed)
    rows = []
    for conv in range(convs):
        for turn in range(int(rng.integers(0, turns))):
            role, text = ROLES[int(rng.integers(9))], TEXTS[int(rng.integers(10))]
            if text and rng.random() < 0.7:
                text = f"{turn} {text}"
            where = None if rng.random() < 0.05 else turn - int(rng.random() < 0.1)
            rows += [(conv if conv else None, where, role, text)] * (1 + int(rng.random() < 0.1))
    return rows


@pytest.mark.parametrize("least_block", [1, 1024])
def test_equals_brute_force(spark, least_block):
    rows = _random_rows(1, 150, 14)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    _check(conversations.Repair(df, least_block=least_block), rows)


def test_one_conversation_of_many_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(9, t, ROLES[int(rng.integers(6))], f"{t % 300} {TEXTS[int(rng.integers(8))]}") for t in range(900)]
    rows += [(9, 400, "user", "again.")] * 50 + [(8, 1, "user", "Hello."), (10, 1, "assistant", "Hello.")]
    df = spark.createDataFrame(rows, SCHEMA)
    repair = conversations.Repair(df, least_block=1)
    assert repair.plans.filter("conv = 9").count() >= 20
    _check(repair, rows)


def test_walk_recomputes_between_checkpoints():
    """The cost that the walk pays is the least cost, whatever the length."""
    rng = np.random.default_rng(4)
    for n in [*range(1, 30), 100, 1000]:
        rows = [conversations.code(ROLES[int(rng.integers(8))], bool(rng.random() < 0.2), bool(rng.random() < 0.3)) for _ in range(n)]
        costs = conversations._END
        for row in reversed(rows):
            costs = conversations.before(row, costs)
        across = conversations.between(rows)
        for state in range(4):
            edits, end, paid = conversations.walk(rows, conversations._END, state, True)
            assert len(edits) == n and end in (0, 3) and paid == costs[state]
            assert costs[state] == min(across[t][state] + conversations._END[t] for t in range(4))


def test_query_equals_brute_force(spark, sf_dir):
    found = queries.QUERIES["op12_conversation_repair"](spark, sf_dir)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == _damaged_and_mended(rows)


def _damaged_and_mended(rows):
    left = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        left += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    by = _by_conversation(left)
    none = (0, 0, 0, 0, 0, 0, "", _sha([]))
    result = {r[0]: none for r in rows}
    for conv, own in by.items():
        numbers, out = _mended(own)
        result[conv] = (*numbers, _sha(out))
    return result


def test_query_on_odd_rows(spark, tmp_path):
    """NULLs in every column, conversations that vanish, extra columns with the operator's names."""
    rows = _random_rows(5, 60, 8) + [(None, None, None, None), (700, None, "user", "x."), (701, 3, "system", "only.")]
    gone = next(c for c in range(800, 900) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((gone, 1, "user", "lost."))
    wide = [(*r, "c", 1, "m") for r in rows]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(wide, SCHEMA + ", conv string, mark bigint, fault string").write.parquet(path)
    found = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert found == _damaged_and_mended(rows)
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", _sha([]))


def test_empty_table_and_long_texts(spark):
    none = conversations.Repair(spark.createDataFrame([], SCHEMA))
    assert none.audit().count() == none.repaired().count() == none.digests().count() == 0
    long = "word " * 400_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (1, 2, "assistant", long + ".")]
    _check(conversations.Repair(spark.createDataFrame(rows, SCHEMA)), rows)
