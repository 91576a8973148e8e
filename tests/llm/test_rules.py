"""Rule counts and host verdicts against brute force, and on odd rows."""

from __future__ import annotations

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from martflow.llm import queries, rules
from martflow.operators.joins import Skew


def _counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = collections.Counter(windows)
    reached = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines), len(lines) - len(set(lines)), len(reached),
    )


ODD = [
    None, "", " \t\n\x0b\x0c\r", "one", "one two", "a b c a b c", "a b c a b c a b c a", "a a a a", "a a a",
    "x\ny\nx\n\n x\nx", "# * $ % & | < >", "é ü ß é ü ß é", "\x85 \xa0 a", "ab c a bc", "a  b\tc\na b c",
]


def test_counts_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = [*ODD, " ".join(f"w{i % 5_000}" for i in range(60_000))]
    odd = spark.createDataFrame([(-i, t) for i, t in enumerate(texts, 1)], "doc_id bigint, text string")
    both = docs.unionByName(odd)
    found = rules.text_counts(both, F.col("text"), F.col("doc_id")).select("doc_id", *rules.COUNTS).collect()
    wanted = {r["doc_id"]: _counts(r["text"]) for r in both.collect()}
    assert len(found) == len(wanted)
    assert {r[0]: tuple(r[1:]) for r in found} == wanted


def test_query_equals_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = queries.QUERIES["op11_host_rules"](spark, sf_dir)
    columns = sorted(found.columns)
    wanted = connection.sql(queries.ORACLE["op11_host_rules"])
    assert sorted(wanted.columns) == columns
    rows = wanted.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall()
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == sorted(rows)
    connection.close()


GOOD = " ".join(f"word{i}" for i in range(60))
NOISY = " ".join(f"word{i} #" for i in range(60))


def test_hosts_are_condemned_by_shrunken_rates(spark):
    """Most documents of one large host fail; a small host with one failure is not condemned for it."""
    rows = [(f"good{h}", GOOD) for h in range(30) for _ in range(20)]
    rows += [("bad", NOISY if i % 10 else GOOD) for i in range(200)] + [("small", NOISY)]
    rows += [("http://User@WWW.Bad:80/x", GOOD), ("https://bad/y?z#q", GOOD)]
    df = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(rows)], "doc_id bigint, text string, source string")
    for skew in (Skew(), Skew(min_bytes=0, min_hot_rows=10)):
        found = rules.quality_rules(df, skew=skew).collect()
        assert len(found) == len(rows)
        by = collections.defaultdict(set)
        for r in found:
            by[r["host"]].add((tuple(r["failed"]), tuple(r["host_failed"]), r["kept"]))
        assert by.pop("bad") == {((), ("symbols",), False), (("symbols",), ("symbols",), False)}
        assert by.pop("small") == {(("symbols",), (), True)}
        assert all(v == {((), (), True)} for v in by.values()) and len(by) == 30


def test_hosts_above_the_broadcast_limit(spark, no_broadcast):
    rows = [(i, GOOD if i % 3 else NOISY, f"h{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = rules.quality_rules(df, skew=Skew(min_bytes=0, min_hot_rows=5))
    assert found.count() == 60 and found.filter("kept").count() == 60


def test_prior():
    # 2 hosts of 100 documents, 20 and 40 failing: their variance less that of drawing
    mean, strength = rules.prior(2, 200.0, 20_000.0, 60, 4.0 + 16.0)
    assert mean == 0.3
    assert strength == pytest.approx(max(10, 0.21 / ((20 - 18 - 0.21) / 100) - 1))
    assert rules.prior(1, 10.0, 100.0, 5, 2.5) == (0.5, rules.MOST_STRENGTH)
    assert rules.prior(0, None, None, None, None)[1] == rules.LEAST_STRENGTH
    # hosts that differ wholly leave the prior its least strength
    assert rules.prior(2, 200.0, 20_000.0, 100, 100.0) == (0.5, rules.LEAST_STRENGTH)


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, source string, key string, host string, __words string, n_words int"
    rows = [
        (1, GOOD, "a", "k", "h", "w", 1), (1, GOOD, "a", "k", "h", "w", 1), (2, None, "a", None, None, None, None),
        (None, GOOD, None, None, None, None, None), (3, "", "", "k", "h", "w", 1), (4, " \n", None, "k", "h", "w", 1),
    ]
    found = rules.quality_rules(spark.createDataFrame(rows, schema))
    names = ["doc_id", "host", *rules.COUNTS, "base_failed", "failed", "host_failed", "kept"]
    assert found.columns == names
    kept = sorted(((r["doc_id"], r["host"], r["kept"]) for r in found.collect()), key=repr)
    assert kept == sorted(
        [(1, "a", True), (1, "a", True), (2, "a", False), (None, None, True), (3, None, False), (4, None, False)], key=repr
    )
    none = spark.createDataFrame([], schema)
    assert rules.quality_rules(none).columns == names and rules.quality_rules(none).count() == 0
