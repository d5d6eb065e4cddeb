"""Writing a derived delivery as feed files, the way an upstream system would drop them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.schemas import FEED_FORMATS, FEED_KEYS, FEED_SCHEMAS

# Rows per outer array; bounds what one JSON file, and so one task, holds.
ROWS_PER_ARRAY = 20_000


def land(rows: DataFrame, feed: str, path: str) -> None:
    """Add files holding the business columns of ``rows`` to the feed's landing folder."""
    rows = rows.select(*FEED_SCHEMAS[feed].fieldNames())
    if FEED_FORMATS[feed] == "csv":
        # Field order is what counts: the header names are not the column names.
        header = rows.toDF(*[f"field {i}" for i in range(len(rows.columns))])
        header.write.mode("append").csv(
            path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
        return
    part = F.expr(f"cast({FEED_KEYS[feed]} as bigint) div {ROWS_PER_ARRAY}")
    arrays = rows.groupBy(part.alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")
    )
    # One task holds one array at a time, and every file exactly one: the file cap of one
    # record does that, as each row is a whole array.
    arrays.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(path)
