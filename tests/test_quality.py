from __future__ import annotations

import pandas as pd
import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from martflow.contract import ColumnRule, Contract, read_contract, write_contract
from martflow.operators import normalize, quality
from martflow.operators.joins import Skew
from martflow.operators.keys import surrogate_keys
from martflow.sources.workdir import run_folder

RULES = Contract.of(
    [
        ("t", "t", "k", "int", "N", "Y", "Y"),
        ("t", "t", "v", "string", "Y", "N", "N"),
        ("pair", "pair", "a", "int", "N", "N", "Y"),
        ("pair", "pair", "b", "int", "N", "N", "Y"),
        ("gone", "gone", "k", "int", "N", "Y", "Y"),
    ]
)


def test_contract_survives_its_file(spark):
    path = run_folder(spark, "contract")
    write_contract(spark, RULES, path)
    assert read_contract(spark, path) == RULES
    assert RULES.required("pair") == ["a", "b"]
    assert [r.table_columns for r in RULES.primary_key("pair")] == ["a", "b"]
    with pytest.raises(KeyError):
        RULES.table("absent")
    with pytest.raises(ValueError):
        Contract.of([("f", "t", "a", "int"), ("g", "t", "b", "int")]).destinations


def test_key_report_finds_all_kinds(spark):
    keyed = spark.createDataFrame([("1", "a"), ("x", "b"), ("12.7", "c"), (None, "d"), ("1", "e")],
                                  "k string, v string")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a int, b int")
    report = quality.pk_report({"t": keyed, "pair": pairs}, RULES)
    found = {(r["table_name"], r["column_name"], r["check_name"]): r["bad_rows"]
             for r in report.collect()}
    assert found == {
        ("t", "k", "null"): 1,
        ("t", "k", "type"): 3,
        ("t", "k", "duplicate"): 1,
        ("pair", "a", "null"): 0,
        ("pair", "b", "null"): 0,
        ("pair", "a", "type"): 0,
        ("pair", "b", "type"): 0,
        ("pair", "a,b", "duplicate"): 0,
        ("gone", "k", "missing table"): None,
    }
    with pytest.raises(ValueError, match="gone"):
        quality.require_valid_keys(report)
    quality.require_valid_keys(report.filter("table_name = 'pair'"))


def test_postal_codes_split_the_table(spark):
    codes = ["12345", "12345-6789", "99999", "1234", "abc", None, " 12345 "]
    df = spark.createDataFrame([(c,) for c in codes], "zip string")
    postal = spark.createDataFrame(
        [("12345", "US"), ("12345", "US"), ("99999", "DE"), ("x", "US")],
        "postal_code string, country_code string",
    )
    kept = quality.valid_postal_codes(df, "zip", postal)
    rejected = quality.rejected_postal_codes(df, "zip", postal)
    assert rows(kept) == [(" 12345 ",), ("12345",), ("12345-6789",)]
    assert kept.count() + rejected.count() == df.count()


def test_orphans_count_values_and_rows(spark):
    facts = spark.createDataFrame([(1,), (1,), (9,), (9,), (8,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(quality.orphans(facts, "fk", dim, "id")) == [(8, 1), (9, 2)]
    report = quality.orphan_report(facts, {"fk": ("dim", dim, "id")})
    assert rows(report) == [("fk", "dim", 2, 3)]


def test_batch_predicate_is_the_only_python_step(spark):
    df = spark.createDataFrame([("a",), ("bb",), (None,)], "s string")
    found = quality.filter_by_batch_predicate(df, "s", lambda s: s.str.len() > 1)
    assert rows(found) == [("bb",)]
    assert "ArrowEvalPython" in plan_of(found)


def test_normalize_keeps_what_each_kind_needs(spark):
    df = spark.createDataFrame(
        [
            (1, " Ann.B@Mail.com ", "(555) 123-4567", "12345-6789"),
            (2, "no address", "12-34", "123"),
            (3, None, "555.123.4567", "12345"),
        ],
        "id int, email string, home_phone string, zip_code string",
    )
    assert rows(normalize.normalize_contacts(df)) == [
        ("ann.b@mail.com", "5551234567", 1, "12345-6789")
    ]
    blanked = normalize.normalize_contacts(df, mode="null")
    assert [tuple(r) for r in blanked.orderBy("id").collect()] == [
        (1, "ann.b@mail.com", "5551234567", "12345-6789"),
        (2, None, None, None),
        (3, None, "5551234567", "12345"),
    ]
    flags = normalize.normalize_contacts(df, ["email"], "flag")
    assert [r["email_valid"] for r in flags.orderBy("id").collect()] == [True, False, False]
    with pytest.raises(ValueError):
        normalize.normalize_contacts(df, mode="guess")


def test_reject_counts_add_up(spark):
    df = spark.createDataFrame([("a@b.cc",), ("bad",), (None,)], "email string")
    report = normalize.contact_rejects(df, "t").first()
    assert (report["rows"], report["valid"], report["rejected"], report["missing"]) == (3, 1, 1, 1)


def test_strip_specials(spark):
    df = spark.createDataFrame([("  Héllo, W-orld!_1 ",)], "s string")
    assert df.select(normalize.strip_specials(F.col("s"))).first()[0] == "hllo world_1"


def test_surrogate_keys_are_dense_over_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 997).alias("v"))
    found = surrogate_keys(df, ["v"], "key")
    assert rows(found) == sorted(((v + 1, v) for v in range(997)), key=repr)


def test_step_audit(spark):
    steps = [("input", spark.range(5)), ("half", spark.range(2))]
    assert rows(quality.step_audit("t", steps)) == [(2, "half", 1, "t"), (5, "input", 0, "t")]


def test_predicate_is_given_whole_series(spark):
    seen = quality.filter_by_batch_predicate(
        spark.range(10), "id", lambda s: pd.Series([v % 2 == 0 for v in s])
    )
    assert seen.count() == 5


def test_step_counts_come_from_the_write(spark):
    counts = quality.StepCounts("t")
    df = counts.watch("input", spark.range(10))
    df = counts.watch("half", df.filter("id < 5"))
    df = counts.watch("none", df.filter("id < 0"))
    df.write.format("noop").mode("overwrite").save()
    assert counts.rows() == [("t", 0, "input", 10), ("t", 1, "half", 5), ("t", 2, "none", 0)]
    assert counts.agrees(10, 0)
    # a task that ran twice shows at an end, or as rows gained
    assert not counts.agrees(9, 0) and not counts.agrees(10, 1)
    counts.steps[1], counts.steps[2] = counts.steps[2], counts.steps[1]
    assert not counts.agrees(10, 5)


KEYED = [
    ColumnRule("t", "t", "a", "int", primary_key="Y"),
    ColumnRule("t", "t", "b", "string", primary_key="Y"),
]


@pytest.mark.parametrize("skew", [Skew(), Skew(min_bytes=0, min_hot_rows=5, salts=3)])
def test_key_gate(spark, no_broadcast, skew):
    data = [("1", "x", 5, 1), ("1", "x", 4, 1), ("1", "x", 4, 1), ("1", "y", 9, 2), (None, "x", 1, 3), ("z", "x", 1, 4), ("2", None, 1, 5)]
    data += [("7", "hot", i % 3, i % 2) for i in range(60)]
    df = spark.createDataFrame(data, "a string, b string, v int, rows int")
    kept, rejects = quality.split_by_key(df, KEYED, skew=skew)
    assert rows(kept) == rows(spark.createDataFrame([("1", "x", 4, 1), ("1", "y", 9, 2), ("7", "hot", 0, 0)], df.schema))
    assert kept.unionByName(rejects.drop(quality.REASON)).exceptAll(df).isEmpty()
    assert kept.count() + rejects.count() == len(data)
    reasons = {r[0]: r[1] for r in rejects.groupBy(quality.REASON).count().collect()}
    assert reasons == {"null": 2, "type": 1, "duplicate": 2 + 59}
    none, nothing = quality.split_by_key(df.limit(0), KEYED, skew=skew)
    assert none.isEmpty() and nothing.isEmpty()
