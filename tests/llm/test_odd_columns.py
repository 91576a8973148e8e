"""Rows without keys or texts, repeated rows and columns with the operators' own names, through the pipeline's stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martflow.llm import lines, quality, simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")

CLASHES = (
    "none key mark held row rows score lines line print known removed_lines root least place words doc "
    "__mark __key __none __row __score __known __lines x.y"
).split()


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    """A few documents, NULLs, repeated rows, and a column for each name."""
    plain = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(40)
    odd = spark.createDataFrame(
        [
            (None, None, "en", "s", None), (None, "A text without a key. " * 9, "en", "s", 9), (901, None, None, None, 0),
            (902, "", "en", "s", 0), (903, " \n\t", "en", "s", 3), (904, "same words " * 30, "en", "s", 1),
            (904, "same words " * 30, "en", "s", 1), (904, "other words " * 30, "en", "s", 1),
        ],
        plain.schema,
    )
    both = plain.unionByName(odd)
    return both.withColumns({c.replace(".", "_dot_"): F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES}).withColumnRenamed("x_dot_y", "x.y")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_keep_all_columns(spark, sf_dir, docs):
    given = {tuple(r) for r in docs.drop("text", "n_chars").collect()}
    counts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        found = out.collect()
        counts[name] = len(found)
        assert {tuple(v for c, v in r.asDict().items() if c not in ("text", "n_chars")) for r in found} <= given, name
        for r in found:
            assert r["mark"] == (None if r["doc_id"] is None else f"mark{r['doc_id']}")
    assert counts["line_dedup"] == docs.count()
    assert 0 < counts["simhash_near_dedup"] < docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.filter("start = 0").count() == docs.count()


def test_stages_on_an_empty_table(spark, sf_dir, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_near_duplicates_with_clashing_names(docs):
    plain = docs.select("doc_id", "text")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert _rows(kept.select("doc_id", "text")) == _rows(simhash.keep_one(plain))


def test_line_dedup_replaces_its_own_column(docs):
    plain = docs.select("doc_id", "text")
    kept = lines.dedup_lines(docs)
    assert kept.columns == [c for c in docs.columns if c != "removed_lines"] + ["removed_lines"]
    assert _rows(kept.select("doc_id", "text", "removed_lines")) == _rows(lines.dedup_lines(plain))


def test_learning_rows_are_bounded_after_the_join(spark, monkeypatch):
    """One key that is repeated a thousand times is learned from once."""
    df = spark.createDataFrame([(1, f"good text {i}") for i in range(1000)] + [(2, "bad text")] * 50, "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, 5)], "doc_id bigint, quality int")
    taken = []
    monkeypatch.setattr(quality, "learn", lambda rows: taken.append(rows))
    quality.fit(df, labels, rows_per_label=3)
    assert [r[2] for r in taken[0]] == [1, 0]
