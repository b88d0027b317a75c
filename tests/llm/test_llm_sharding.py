"""Histogram sharding: byte balance, gapless slots, whole groups, hot groups and edge cases."""

import zlib

from pyspark.sql import functions as F

from llm_frames import awkward, documents, with_clashes
from tidewatch.llm.sharding import op1_histogram_sharding, shard_documents

FOLDER = "/root/testdata/sf0.01"


def sharded(docs, shards, **options):
    return shard_documents(docs, shards, size=F.octet_length("text") + 1, group=F.col("text"),
                           order=[F.col("doc_id")], **options).toPandas()


def gapless(frame):
    return all(sorted(part["slot"]) == list(range(len(part))) for _, part in frame.groupby("shard"))


def test_query_holds_the_byte_law(spark):
    found = op1_histogram_sharding(spark, FOLDER).toPandas()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas().set_index("doc_id")
    assert sorted(found["doc_id"]) == sorted(docs.index) and gapless(found)
    for row in found.itertuples():
        raw = (docs.loc[row.doc_id, "text"] or "").encode()
        assert (row.size, row.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    sums = found.groupby("shard")["size"].sum()
    assert len(sums) == 16 and (abs(sums - sums.mean()) <= found["size"].max()).all()
    assert found["grown_shard"].isna().all() and set(found["law"]) == {"bytes"}


def test_equal_texts_stay_together_where_bytes_allow(spark):
    rows = [(i, f"text {i // 3} " + "w" * (i // 3 % 50), None, None, None) for i in range(3000)]
    found = sharded(documents(spark, rows), 4)
    homes = found.groupby("text")["shard"].nunique()
    sums = found.assign(b=found["text"].str.len() + 1).groupby("shard")["b"].sum()
    assert (homes == 1).all() and sums.max() < 1.03 * sums.mean() and gapless(found)


def test_hot_group_is_cut(spark):
    rows = [(i, "the very same text", None, None, None) for i in range(2000)]
    rows += [(i, f"other {i}", None, None, None) for i in range(2000, 4000)]
    found = sharded(documents(spark, rows), 8, cell_rows=100)
    counts = found.assign(b=found["text"].str.len() + 1).groupby("shard")["b"].sum()
    assert gapless(found) and counts.max() < 1.02 * counts.mean()


def test_equal_rows_are_cut_too(spark):
    found = sharded(documents(spark, [(7, "same", "x", "y", 1)] * 1000), 4)
    assert gapless(found) and found.groupby("shard").size().tolist() == [250] * 4


def test_awkward_rows_and_clashing_names(spark):
    docs = with_clashes(documents(spark))
    found = sharded(docs, 5)
    assert gapless(found) and len(found) == len(awkward())
    assert set(found.columns) == set(docs.columns) and set(found["cell"]) == {"own cell"}
    assert found["shard"].between(0, 4).all()


def test_empty_table(spark):
    assert sharded(documents(spark, []), 3).empty
