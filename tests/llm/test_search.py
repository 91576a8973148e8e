"""Ranked search against brute force: masks, segments, blocks of items, ties and odd rows."""

from __future__ import annotations

import collections
import math
import re

import duckdb
import numpy as np
import pytest

from martflow.llm import queries, search

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return _TERM.findall(lowered)


def _ranked(docs, items, top=10):
    """By definition: docs and items are (key, text)."""
    held = [(key, collections.Counter(_terms(text))) for key, text in docs]
    held = [(key, c) for key, c in held if c]
    n_docs, n_all = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    merged = collections.defaultdict(list)
    for key, text in set(items):
        merged[key] += _terms(text)
    out = []
    for item, terms in merged.items():
        scores = []
        for key, c in held:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms
                if t in c
            )
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, i, x[3], -x[0]) for i, x in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_sql(spark, sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    found = queries.QUERIES["op13_ranked_search"](spark, sf_dir)
    wanted = connection.sql(queries.ORACLE["op13_ranked_search"])
    assert wanted.columns == found.columns
    assert _found(found) == sorted(wanted.fetchall(), key=repr)
    connection.close()


@pytest.fixture(scope="module")
def made():
    """Items of up to 150 terms over a skewed vocabulary, documents with equal scores, copies and NULL ids."""
    rng = np.random.default_rng(7)
    words = [f"Wort{i}é" if i % 7 == 0 else f"w{i}" for i in range(300)]

    def text(n):
        return " ".join(words[min(int(i), 299)] for i in rng.zipf(1.3, n) - 1)

    docs = [(i, text(int(rng.integers(1, 120)))) for i in range(400)]
    docs += [(1000 + i, docs[i % 5][1]) for i in range(40)] + [(None, docs[0][1]), (None, "w1"), (7, docs[7][1])]
    items = [(i, text(int(n))) for i, n in enumerate([1, 2, 5, 30, 90, 400, 400])]
    items += [(50, " ".join(words[k * 2] for k in range(150)))]
    return docs, items


@pytest.mark.parametrize("segment_docs,block_terms", [(1 << 14, 200_000), (37, 200_000), (64, 1), (1, 60)])
def test_equals_brute_force(spark, made, segment_docs, block_terms):
    docs, items = made
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    queried = spark.createDataFrame(items, "item_id bigint, text string")
    found = search.ranked(df, queried, segment_docs=segment_docs, block_terms=block_terms)
    assert _found(found) == _ranked(docs, items)


def test_mask_groups_come_by_descending_maximum():
    rng = np.random.default_rng(3)
    for terms in (1, 8, 9, 64, 65, 130):
        present = rng.random((terms, 500)) < 0.2
        bounds = rng.integers(1, 1000, terms)
        rounds = list(search.mask_groups(np.packbits(present, axis=1), 500, bounds))
        masks = [tuple(present[:, d]) for d in range(500)]
        most = np.array([int(bounds[present[:, d]].sum()) for d in range(500)])
        seen = np.concatenate([members for _, members in rounds])
        assert sorted(seen.tolist()) == [d for d in range(500) if any(masks[d])]
        before = math.inf
        closed = set()
        for bound, members in rounds:
            assert bound == most[members].max() <= before
            own = {masks[d] for d in members.tolist()}
            assert not own & closed  # a mask is never split
            closed |= own
            before = most[members].min()


def test_search_stops_safely(monkeypatch):
    """Documents below the tenth score stay unscored, and none above it is missed."""
    import pyarrow as pa

    docs = [(i, "common") for i in range(3_000)] + [(5_000 + i, "rare common " * (i + 1)) for i in range(12)]
    items = [(1, "rare common")]
    vocabulary = {b"rare": 0, b"common": 1}
    part = search._Segment()
    for key, text in docs:
        count, hits = search._found(text.encode(), vocabulary)
        part.places += [len(part.sizes)] * len(hits)
        part.hits += hits
        part.sizes.append(count)
        part.keys.append(pa.array([key]))
    row = part.row(2)
    one = {name: row.column(i).flatten() for i, name in enumerate(row.schema.names)}
    one = {k: v if k == "keys" else v.to_numpy(zero_copy_only=False) for k, v in one.items()}
    held = np.array([12, 3_012])
    counts = search.Corpus(len(docs), sum(part.sizes), held)
    block = search.Items([1], [np.array([0, 1])], [np.array([1, 1])], vocabulary)
    answers = search._Answers(block, counts, 10)
    scored = []
    add = answers.add
    monkeypatch.setattr(answers, "add", lambda i, s, p, k: (scored.append(len(p)), add(i, s, p, k)))
    answers.search(one)
    assert sum(scored) < 3_000
    assert [(1, i, x[2], -x[0]) for i, x in enumerate(answers.best[0], 1)] == sorted(_ranked(docs, items), key=lambda r: r[1])


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(search, "PIECE_BYTES", 7)
    text = "ab,cd  ef;ghijklmnopq r ab"
    count, hits = search._found(text.encode(), {b"ab": 0, b"ghijklmnopq": 1})
    assert count == 6 and np.concatenate(hits).tolist() == [0, 1, 0]


def test_odd_rows(spark):
    schema = "doc_id string, text string, item_id int, rank int, score int, number int"
    rows = [
        ("a", "One two", 1, 1, 1, 1), ("a", "One two", 1, 1, 1, 1), (None, "one", None, None, None, None),
        ("b", None, 1, 1, 1, 1), ("c", "", 1, 1, 1, 1), ("d", " ,;", 1, 1, 1, 1), ("e", "x " * 200_000 + "two", 1, 1, 1, 1),
    ]
    items = [("i", "ONE", "k"), ("i", "ONE", "k"), ("i", "two one", None), (None, "two", "k"), ("n", None, "k"), ("m", "", "k")]
    df = spark.createDataFrame(rows, schema)
    queried = spark.createDataFrame(items, "item_id string, text string, doc_id string")
    found = search.ranked(df, queried)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]

    def order(rows):
        return sorted((r[0], r[1], r[3]) for r in rows if r[0]) + sorted((r[1], r[3]) for r in rows if not r[0])

    wanted = _ranked([(r[0] and ord(r[0]), r[1]) for r in rows], [(i[0], i[1]) for i in items])
    assert order(_found(found)) == order(wanted)
    for a, b in ((df.limit(0), queried), (df, queried.limit(0)), (df.filter("doc_id = 'b'"), queried)):
        none = search.ranked(a, b)
        assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0
