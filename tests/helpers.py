"""Small building blocks shared by the tests."""

from __future__ import annotations

import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from stayflow.schemas import FEED_SCHEMAS, KEY


def new_dir(name: str = "run") -> str:
    return tempfile.mkdtemp(prefix=f"stayflow-{name}-")


def evaluate(spark, apply, texts):
    """The function's result per input text."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r.r for r in df.select("i", apply(F.col("v")).alias("r")).orderBy("i").collect()]


def raw_rows(spark, feed, rows, batch=1, loaded="2024-06-01 05:00:00", filename="f"):
    texts = [tuple(None if v is None else str(v) for v in r) for r in rows]
    return spark.createDataFrame(texts, FEED_SCHEMAS[feed]).withColumns(
        {
            "_loaded_at": F.lit(loaded).cast("timestamp_ntz"),
            "_filename": F.lit(filename),
            "_batch_id": F.lit(batch).cast("bigint"),
        }
    )


def typed(spark, rows, schema):
    """Rows of a declared table, business keys given as plain integers."""
    keys = [f.dataType.simpleString() == KEY for f in schema.fields]
    cast = [tuple(Decimal(v) if k and v is not None else v for k, v in zip(keys, row)) for row in rows]
    return spark.createDataFrame(cast, schema)


def rows_of(df, *drop):
    keep = [c for c in df.columns if c not in drop]
    return sorted((tuple(r) for r in df.select(*sorted(keep)).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
