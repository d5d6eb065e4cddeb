"""Row-wise Arrow work and the tables the operators store on the way."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from stayflow.llm import remembered
from stayflow.sources.scratch import materialise, shared_dir

# Rows of one output batch, so that long texts and what is made of them stay small together.
ROWS_PER_BATCH = 64


def add_columns(df: DataFrame, column: str, schema: str, make: Callable[[], Callable]) -> DataFrame:
    """``df`` with the columns of ``schema``, worked out from one column by Python in Arrow batches.

    ``make`` is called once per task and returns a function from the column's value (``None``
    for null) to a tuple of the new values. Columns of the same name are replaced; all
    others pass through untouched. A task holds a few rows at a time, whatever its size.
    """
    new = _parse_datatype_string(schema)
    kept = [f for f in df.schema.fields if f.name not in new.names]
    source = df.columns.index(column)
    keep = [df.columns.index(f.name) for f in kept]
    types = [to_arrow_type(f.dataType) for f in new.fields]
    names = [f.name for f in kept] + new.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = remembered.KEPT.begin(make)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(start, ROWS_PER_BATCH)
                made = list(zip(*map(work, part.column(source).to_pylist())))
                arrays = [pa.array(values, t) for values, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in keep] + arrays, names)

    return df.mapInArrow(run, StructType(kept + [StructField(f.name, f.dataType) for f in new.fields]))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it a name that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Work:
    """A shared folder for the tables of one call; ``drop`` deletes tables no result reads."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.base, self._n = spark, shared_dir(spark), 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Written once and read back: cuts the lineage and survives lost executors."""
        return materialise(df, self.path(name))

    def release(self) -> None:
        """Let Spark delete shuffle files of what has been stored: it does so when the driver's
        garbage collector finds their owners gone, which on its own may be much later."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *stored: DataFrame) -> None:
        for df in stored:
            for file in df.inputFiles()[:1]:
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(file.rsplit("/", 1)[0])
                files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
                files.delete(folder, True)
