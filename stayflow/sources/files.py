"""Readers for the delivered feed files (batch and streaming share them)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stayflow.functions.parse import FILE_NULL_TOKENS
from stayflow.schemas import FEED_FORMATS, FEED_MULTI_LINE, FEED_SCHEMAS

# Damaged input is marked, never dropped in silence: the reason, and the text it concerns.
DAMAGE, RECORD = "_damage", "_record"
# A record with too few or too many fields: loaded, padded or cut.
WIDTH = "record width"
# The rest cannot be loaded: a piece of a record cut at a quoted line break, an object or
# a file that does not parse, and a file that stops before its end.
TORN, OBJECT, FILE, NO_END = "torn record", "unreadable object", "unreadable file", "file without end"
LOADED = (WIDTH,)

# Options of the delivered files.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "enforceSchema": "true"}
JSON_OPTIONS = {"primitivesAsString": "true"}
ARRAY, LINES = "array", "lines"


def null_tokens(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = FILE_NULL_TOKENS) -> DataFrame:
    """NULL where a column holds exactly one of ``tokens`` (case and blanks count)."""
    return df.withColumns({c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in cols})


def _source(reader, fmt: str, schema: StructType, multi_line: bool, layout: str, fail: bool):
    """A batch or stream reader with the format's options; lines are taken as they are."""
    if fmt == "json" and layout == LINES:
        return reader.format("text")
    whole = multi_line if fmt == "csv" else True
    options = {**(CSV_OPTIONS if fmt == "csv" else JSON_OPTIONS), "multiLine": str(whole).lower()}
    options |= {"mode": "FAILFAST"} if fail else {"columnNameOfCorruptRecord": RECORD}
    marked = schema if fail else StructType([*schema.fields, StructField(RECORD, StringType())])
    return reader.format(fmt).schema(marked).options(**options)


def _marked(df: DataFrame, fmt: str, schema: StructType, layout: str, fail: bool) -> DataFrame:
    """Feed columns, file metadata, and what is damaged."""
    if fmt == "json" and layout == LINES:
        return _from_lines(df, schema, fail)
    if fail:
        damage = F.lit(None).cast("string")
        df = df.withColumn(RECORD, F.lit(None).cast("string"))
    elif fmt == "csv":
        quotes = F.char_length(RECORD) - F.char_length(F.replace(F.col(RECORD), F.lit('"'), F.lit("")))
        damage = F.when(quotes % 2 == 1, TORN).when(F.col(RECORD).isNotNull(), WIDTH)
    else:
        damage = F.when(F.col(RECORD).isNotNull(), FILE)
    names = schema.fieldNames()
    return null_tokens(df.select(*names, "_metadata", damage.alias(DAMAGE), RECORD), names)


def _from_lines(lines: DataFrame, schema: StructType, fail: bool) -> DataFrame:
    """Objects of arrays that are laid out by lines: whole objects in every line. A line is parsed as an
    array of its own, so a file is read by as many tasks as its size asks for."""
    names = schema.fieldNames()
    bare = F.regexp_replace(F.regexp_replace("value", r"^\s*\[", ""), r",?\s*\]?\s*$", "")
    kind = f"array<struct<{', '.join(f'`{n}`: string' for n in names)}>>"
    objects = F.from_json(F.concat(F.lit("["), bare, F.lit("]")), kind, JSON_OPTIONS)
    parsed = lines.select("value", "_metadata", objects.alias("objects")).where("objects is null or size(objects) > 0")
    damage = F.when(F.col("objects").isNull(), F.raise_error("unreadable object").cast("string") if fail else OBJECT)
    rows = parsed.select(
        F.explode_outer("objects").alias("object"),
        "_metadata",
        damage.alias(DAMAGE),
        F.when(F.col("objects").isNull(), F.col("value")).alias(RECORD),
    ).select(*[F.col(f"object.{n}").alias(n) for n in names], "_metadata", DAMAGE, RECORD)
    ends = lines.groupBy("_metadata.file_path").agg(
        F.first("_metadata").alias("_metadata"), F.bool_or(F.col("value").rlike(r"\]\s*$")).alias("ended")
    )
    complaint = F.raise_error(F.concat(F.lit(f"{NO_END}: "), "file_path")).cast("string") if fail else F.lit(NO_END)
    open_ended = ends.where("not ended").select(
        *[F.lit(None).cast("string").alias(n) for n in names],
        "_metadata",
        complaint.alias(DAMAGE),
        F.lit(None).cast("string").alias(RECORD),
    )
    return null_tokens(rows.unionByName(open_ended), names)


def read_csv_feed(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, fail: bool = False
) -> DataFrame:
    """Comma-separated files with one header line. Columns bind by position, whatever the
    header calls them; short rows are padded with NULL, extra fields dropped.

    ``multi_line`` is the caller's choice per feed. With it a quoted field may hold line breaks, but
    each file is read by one task; without it files are split, and a record with a quoted line
    break falls into pieces, which are marked as torn. Records of another width are marked too,
    unless ``fail`` asks for an error.
    """
    reader = _source(spark.read, "csv", schema, multi_line, ARRAY, fail)
    return _marked(reader.load(path).select("*", "_metadata"), "csv", schema, ARRAY, fail)


def read_json_feed(
    spark: SparkSession, path: str, schema: StructType, layout: str = ARRAY, fail: bool = False
) -> DataFrame:
    """Files holding one outer array of flat objects; a row per object, every value as text.

    With the layout "array" nothing is asked of line breaks; such a file cannot be split, so it is the unit of
    parallelism, and a file that does not parse is one marked row with its whole text. With "lines" a
    line holds whole objects (one or more): large files are split, and only what is
    damaged is lost, a line at a time; a file without a closing bracket is marked as well. ``fail`` asks for an
    error instead of marks.
    """
    reader = _source(spark.read, "json", schema, True, layout, fail)
    return _marked(reader.load(path).select("*", "_metadata"), "json", schema, layout, fail)


def read_feed(spark: SparkSession, feed: str, path: str, layout: str = ARRAY, multi_line: bool | None = None) -> DataFrame:
    if FEED_FORMATS[feed] == "json":
        return read_json_feed(spark, path, FEED_SCHEMAS[feed], layout)
    return read_csv_feed(spark, path, FEED_SCHEMAS[feed], FEED_MULTI_LINE[feed] if multi_line is None else multi_line)


def stream_feed(
    spark: SparkSession,
    feed: str,
    path: str,
    max_files: int | None = None,
    layout: str = ARRAY,
    multi_line: bool | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The same feed as a file stream: each arriving file is seen once per checkpoint. Its batches
    become feed rows by ``delivered``. With ``archive`` files go there once they are loaded,
    so that the folder that is listed stays short."""
    multi_line = FEED_MULTI_LINE.get(feed, True) if multi_line is None else multi_line
    reader = _source(spark.readStream, FEED_FORMATS[feed], FEED_SCHEMAS[feed], multi_line, layout, False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path).select("*", "_metadata")


def delivered(batch: DataFrame, feed: str, layout: str = ARRAY) -> DataFrame:
    """Feed rows of a micro-batch of ``stream_feed``, damaged ones marked."""
    return _marked(batch, FEED_FORMATS[feed], FEED_SCHEMAS[feed], layout, False)


def loadable() -> Column:
    """Is this row one to load?"""
    return F.col(DAMAGE).isNull() | F.col(DAMAGE).isin(*LOADED)


def with_load_metadata(df: DataFrame, batch_ts: datetime | str | Column, batch_id: int) -> DataFrame:
    """Add load time (one value per load), source file and batch number to feed rows."""
    return df.withColumns(
        {
            "_loaded_at": timestamp_literal(batch_ts),
            "_filename": F.col("_metadata.file_path"),
            "_batch_id": F.lit(batch_id).cast("bigint"),
        }
    ).drop("_metadata")


def timestamp_literal(ts: datetime | str | Column) -> Column:
    """A run's timestamp as a zone-free column; datetimes and text are taken as UTC."""
    if isinstance(ts, Column):
        return ts.cast("timestamp_ntz")
    text = ts.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(ts, datetime) else ts
    return F.lit(text).cast("timestamp_ntz")
