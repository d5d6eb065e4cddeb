"""Incremental file ingest: every arriving file is loaded into its raw table once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayflow.schemas import FEED_KEYS, FEED_SCHEMAS
from stayflow.sources.files import ARRAY, DAMAGE, RECORD, delivered, loadable, stream_feed, with_load_metadata
from stayflow.sources.store import Store

FIRST_BATCH = 1
# Characters of a damaged record that are kept: a whole file may be one.
RECORD_CHARS = 2000


def load_batch(
    store: Store, feed: str, rows: DataFrame, batch_ts: datetime | str, batch: int, layout: str = ARRAY
) -> None:
    """Write a micro-batch: rows to the raw table, and what was damaged to the quarantine, of
    which the batch is read a second time only if there is any. Both replace what an earlier try
    of the same batch has left, so a replay changes nothing."""
    seen = Observation()
    stamped = with_load_metadata(delivered(rows, feed, layout), batch_ts, batch)
    store.append_raw(feed, stamped.observe(seen, F.count(DAMAGE).alias("damaged")).where(loadable()))
    if seen.get["damaged"]:
        reports = stamped.where(F.col(DAMAGE).isNotNull()).withColumns(
            {
                "feed": F.lit(feed),
                "reason": F.col(DAMAGE),
                "key_text": F.col(FEED_KEYS[feed]),
                "record": F.left(F.col(RECORD), F.lit(RECORD_CHARS)),
            }
        )
        store.append_quarantine(feed, reports)


def start_ingest(
    store: Store,
    feed: str,
    landing: str,
    batch_ts: datetime | str,
    max_files: int | None = None,
    layout: str = ARRAY,
    multi_line: bool | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Start loading all files under ``landing`` the checkpoint has not seen, then stop.

    A micro-batch may be replayed after a failure; it carries the same number then and
    replaces its own raw and quarantine partitions, so no row is loaded twice. ``layout`` (JSON) and
    ``multi_line`` (CSV) are the readers' choices. With ``archive``, a folder outside ``landing``, loaded
    files are moved there by the batches after theirs.
    """
    files = stream_feed(store.spark, feed, landing, max_files, layout, multi_line, archive)
    return (
        files.writeStream.foreachBatch(
            lambda rows, micro_batch: load_batch(store, feed, rows, batch_ts, micro_batch + FIRST_BATCH, layout)
        )
        .option("checkpointLocation", store.path("ingest", feed))
        .trigger(availableNow=True)
        .start()
    )


def ingest_feed(store: Store, feed: str, landing: str, batch_ts: datetime | str, max_files: int | None = None, **choices) -> None:
    start_ingest(store, feed, landing, batch_ts, max_files, **choices).awaitTermination()


def ingest_all(store: Store, landing_root: str, batch_ts: datetime | str) -> None:
    """All six feeds side by side, each from ``<landing_root>/<feed>``."""
    running = [start_ingest(store, feed, f"{landing_root}/{feed}", batch_ts) for feed in FEED_SCHEMAS]
    for query in running:
        query.awaitTermination()
