import os
import sys

import pytest
from rows_at_the_edge import CLASHES, edge_rows

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from helpers import new_dir  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def stored(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")
    return df.sparkSession.read.parquet(f"{folder}/{name}.parquet")


def test_edge_rows_pass_every_stage(spark):
    folder = new_dir("pipeline")
    df = edge_rows(spark).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs = stored(df, folder, "documents")
    stored(spark.createDataFrame([(3, 1, 0), (5, 0, 0), (6, 1, None)], "doc_id bigint, quality int, toxic int"), folder, "labels")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stored(stage(spark, docs, folder), folder, f"stage{k}")
        if k < 4:
            assert made.columns == docs.columns
        docs = made
    rows = docs.collect()
    assert all(r.decodes for r in rows) and {r.key for r in rows} == {"own"} and set(CLASHES) <= set(docs.columns)
    assert {0, 1, 2, 3, 6, 7, 8} <= {r.doc_id for r in rows} and 4 not in {r.doc_id for r in rows}


def test_empty_tables_pass_every_stage(spark):
    folder = new_dir("pipeline")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = stored(spark.createDataFrame([], schema), folder, "documents")
    stored(spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), folder, "labels")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, folder), folder, f"stage{k}")
    assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_stages_on_the_smallest_tables(spark):
    folder, docs = new_dir("pipeline"), spark.read.parquet(f"{SF_DIR}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SF_DIR), folder, f"stage{k}")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            assert set(before) - ids <= toxic | (set(before) - toxic) and len(ids) >= len(before) - 2 * len(toxic) - 10
        if name == "mixing to target weights":
            assert ids == last  # noqa: F821
        last = ids
    assert docs.where("not decodes").count() == 0
