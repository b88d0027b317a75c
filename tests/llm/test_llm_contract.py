"""The registered queries of the subpackage and the pipeline."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from compare import open_tables, rows_of
from llm_frames import awkward, documents
from test_llm_pairs import brute_components
from tidewatch.llm import registry
from tidewatch.llm.packing import tokenizer_path
from tidewatch.llm.tokens import WordTokens

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(registry.queries())
    assert names | {"pipeline"} <= set(contract.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = registry.queries()[name](spark, FOLDER).toPandas()
    want = open_tables(FOLDER).execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


def test_stages_keep_columns_and_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    frames = []
    for _, stage in corpus_pipeline.STAGES:
        docs = _kept(spark, stage(spark, docs, FOLDER))
        frames.append(docs)
    quality, lines, groups, mixed, packed = frames
    assert all(f.columns == before.columns for f in frames[:-1])
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = quality.join(labels.filter("quality = 1"), "doc_id").count()
    assert good > 0.85 * before.join(labels.filter("quality = 1"), "doc_id").count()
    assert lines.count() == quality.count()
    rows = [(r["doc_id"], r["text"]) for r in lines.collect()]
    want = brute_components(rows)
    assert sorted(r["doc_id"] for r in groups.collect()) == sorted(
        d for d, _ in rows if want[d] == d)
    assert {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in groups.collect()}
    tokens = WordTokens(tokenizer_path())
    total = sum(len(tokens.encode(r["text"] or "")) // 4 + 1 for r in mixed.collect())
    assert packed.agg(F.sum("length")).first()[0] == total


def _kept(spark, frame):
    return spark.createDataFrame(frame.collect(), frame.schema)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = _kept(spark, stage(spark, docs, FOLDER))
    shown = ["doc_id", "piece", "start", "length", "ids_crc32"]
    first = docs.select(shown).toPandas().sort_values(shown).reset_index(drop=True)
    second = corpus_pipeline.run(spark, FOLDER).select(shown).toPandas().sort_values(shown)
    pd.testing.assert_frame_equal(first, second.reset_index(drop=True))


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (awkward(), []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = _kept(spark, stage(spark, docs, FOLDER))
        assert (docs.count() > 0) == bool(rows)
