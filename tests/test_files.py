import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import new_dir, rows_of
from stayflow.schemas import FEED_SCHEMAS
from stayflow.sources.files import (
    DAMAGE,
    FILE,
    LINES,
    NO_END,
    OBJECT,
    RECORD,
    TORN,
    WIDTH,
    read_csv_feed,
    read_json_feed,
    stream_feed,
    with_load_metadata,
)
from stayflow.sources.store import Store
from stayflow.streaming.ingest import ingest_all, ingest_feed, load_batch


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)


def test_csv_binds_by_position_pads_and_drops(spark):
    path = new_dir()
    _write(
        path,
        "a.csv",
        'who,what,x,y,z\n1,"Doe, ""J""",a@b.c, 555 ,rome\n2,short\n3,n,e,p,c,extra\n4,nan,NULL,none,??\n5,,null,"",Nan\n',
    )
    df = read_csv_feed(spark, path, FEED_SCHEMAS["customers"]).orderBy("customerid")
    rows = df.drop("_metadata", DAMAGE, RECORD).collect()
    assert [tuple(r) for r in rows] == [
        ("1", 'Doe, "J"', "a@b.c", " 555 ", "rome"),
        ("2", "short", None, None, None),
        ("3", "n", "e", "p", "c"),
        ("4", None, "NULL", None, None),
        ("5", None, None, None, "Nan"),
    ]
    assert [(r[DAMAGE], r[RECORD]) for r in df.collect()] == [
        (None, None), (WIDTH, "2,short"), (WIDTH, "3,n,e,p,c,extra"), (None, None), (None, None)]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv_feed(spark, path, FEED_SCHEMAS["customers"], fail=True).collect()


def test_json_outer_array_is_unwrapped_as_text(spark):
    path = new_dir()
    objects = [
        {"reviewid": 1, "bookingid": "7", "rating": 4.5, "sentiment": "nan"},
        {"reviewid": 2, "comments": "a \"b\"", "customerid": None},
    ]
    _write(path, "a.json", json.dumps(objects, indent=1))
    df = read_json_feed(spark, path, FEED_SCHEMAS["reviews"])
    rows = [tuple(r) for r in df.drop("_metadata", DAMAGE, RECORD).orderBy("reviewid").collect()]
    assert rows == [("1", "7", None, "4.5", None, None), ("2", None, None, None, 'a "b"', None)]


def test_load_metadata_names_the_file(spark):
    path = new_dir()
    _write(path, "a.csv", "h\n1,Inn,Rome,3,9\n")
    _write(path, "b.csv", "h\n2,Inn,Rome,3,9\n")
    df = with_load_metadata(read_csv_feed(spark, path, FEED_SCHEMAS["hotels"]), "2024-06-01 05:00:00", 4)
    rows = df.orderBy("hotelid").collect()
    assert [os.path.basename(r._filename) for r in rows] == ["a.csv", "b.csv"]
    assert {(str(r._loaded_at), r._batch_id) for r in rows} == {("2024-06-01 05:00:00", 4)}


def test_ingest_loads_each_file_once(spark):
    root, landing = new_dir("store"), new_dir("landing")
    store = Store(spark, root)
    _write(landing, "a.csv", "h\n1,Inn,Rome,3,9\n")
    ingest_feed(store, "hotels", landing, "2024-06-01 05:00:00")
    ingest_feed(store, "hotels", landing, "2024-06-01 06:00:00")
    assert store.read_raw("hotels").count() == 1
    _write(landing, "b.csv", "h\n2,Inn,Rome,3,9\n")
    _write(landing, "c.csv", "h\n3,Inn,Rome,3,9\n")
    ingest_feed(store, "hotels", landing, "2024-06-02 05:00:00", max_files=1)
    rows = rows_of(store.read_raw("hotels").select("hotelid", "_batch_id"))
    assert sorted(r[1] for r in rows) == ["1", "2", "3"]
    assert sorted(r[0] for r in rows) == [1, 2, 3]


def test_replayed_batch_replaces_its_rows(spark):
    store = Store(spark, new_dir("store"))
    landing = new_dir("landing")
    _write(landing, "a.csv", "h\n1,Inn,Rome,3,9\n")
    batch = with_load_metadata(read_csv_feed(spark, landing, FEED_SCHEMAS["hotels"]), "2024-06-01 05:00:00", 1)
    store.append_raw("hotels", batch)
    store.append_raw("hotels", batch)
    assert store.read_raw("hotels").count() == 1


def test_ingest_all_feeds(spark):
    store, landing = Store(spark, new_dir("store")), new_dir("landing")
    for feed in ("bookings", "customers", "hotels", "staff"):
        width = len(FEED_SCHEMAS[feed].fields)
        _write(f"{landing}/{feed}", "a.csv", "h\n" + ",".join(["1"] * width) + "\n")
    for feed in ("reviews", "room_rates"):
        _write(f"{landing}/{feed}", "a.json", json.dumps([{c: "1" for c in FEED_SCHEMAS[feed].fieldNames()}]))
    ingest_all(store, landing, "2024-06-01 05:00:00")
    assert {feed: store.read_raw(feed).count() for feed in FEED_SCHEMAS} == dict.fromkeys(FEED_SCHEMAS, 1)


def test_quoted_line_breaks_are_the_callers_choice(spark):
    path = new_dir()
    _write(path, "a.csv", 'h\n1,"Ann\nLee",x,5,rome\n2,"say ""hi""",y,6,oslo\n')
    whole = read_csv_feed(spark, path, FEED_SCHEMAS["customers"], multi_line=True).orderBy("customerid").collect()
    assert [(r.customerid, r.customername, r.city, r[DAMAGE]) for r in whole] == [
        ("1", "Ann\nLee", "rome", None), ("2", 'say "hi"', "oslo", None)]
    split = read_csv_feed(spark, path, FEED_SCHEMAS["customers"]).collect()
    assert sorted((r[DAMAGE] or "", r[RECORD]) for r in split) == [
        ("", None), (TORN, '1,"Ann'), (TORN, 'Lee",x,5,rome')]


def test_truncated_json_file_is_reported(spark):
    path = new_dir()
    _write(path, "bad.json", '[{"reviewid":1},\n{"reviewid":2},{"review')
    _write(path, "good.json", '[{"reviewid":3}]')
    df = read_json_feed(spark, path, FEED_SCHEMAS["reviews"])
    rows = df.select("reviewid", DAMAGE, RECORD, "_metadata.file_name").orderBy("file_name").collect()
    assert [(r.reviewid, r[DAMAGE], r.file_name) for r in rows] == [(None, FILE, "bad.json"), ("3", None, "good.json")]
    assert rows[0][RECORD].startswith('[{"reviewid":1}')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_json_feed(spark, path, FEED_SCHEMAS["reviews"], fail=True).collect()


LINE_FILE = """[
{"reviewid":1,"rating":4.5,"comments":"a, ]"},
{"reviewid":2,"sentiment":"nan"}, {"reviewid":3}
{"reviewid":4,"rating"

 , {"reviewid":5} ] """


def test_json_lines_lose_only_what_is_damaged(spark):
    path = new_dir()
    _write(path, "a.json", LINE_FILE)
    _write(path, "b.json", '[{"reviewid":6},\n{"reviewid":7},\n')
    df = read_json_feed(spark, path, FEED_SCHEMAS["reviews"], layout=LINES)
    rows = df.select("reviewid", "rating", "comments", "sentiment", DAMAGE, RECORD, "_metadata.file_name").collect()
    good = sorted(tuple(r)[:4] for r in rows if r[DAMAGE] is None)
    assert good == [("1", "4.5", "a, ]", None), ("2", None, None, None), ("3", None, None, None),
                    ("6", None, None, None), ("7", None, None, None)]
    # A stray comma before an object spoils its line.
    assert sorted((r.file_name, r[DAMAGE], r[RECORD]) for r in rows if r[DAMAGE]) == [
        ("a.json", OBJECT, ' , {"reviewid":5} ] '), ("a.json", OBJECT, '{"reviewid":4,"rating"'), ("b.json", NO_END, None)]
    with pytest.raises(Exception, match="unreadable object|without end"):
        read_json_feed(spark, path, FEED_SCHEMAS["reviews"], layout=LINES, fail=True).collect()


def test_large_json_lines_file_gives_several_tasks(spark):
    path = new_dir()
    lines = ",\n".join(json.dumps({"reviewid": i, "comments": "x" * 90}) for i in range(20_000))
    _write(path, "a.json", f"[\n{lines}\n]\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = read_json_feed(spark, path, FEED_SCHEMAS["reviews"], layout=LINES)
        parts = df.where("reviewid is not null").groupBy(F.spark_partition_id()).count().count()
        assert parts >= 8 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_damaged_files_go_to_quarantine_and_a_replay_changes_nothing(spark):
    store, landing = Store(spark, new_dir("store")), new_dir("landing")
    _write(landing, "a.json", '[{"reviewid":1},{"reviewid":2}]')
    _write(landing, "b.json", '[{"reviewid":3},{"rev')
    assert store.read_quarantine("reviews").count() == 0
    ingest_feed(store, "reviews", landing, "2024-06-01 05:00:00")
    assert sorted(r.reviewid for r in store.read_raw("reviews").collect()) == ["1", "2"]
    (report,) = store.read_quarantine("reviews").collect()
    assert (report.feed, report.reason, os.path.basename(report._filename)) == ("reviews", FILE, "b.json")
    batch = spark.read.schema(stream_feed(spark, "reviews", landing).drop("_metadata").schema)
    batch = batch.options(multiLine="true", primitivesAsString="true", columnNameOfCorruptRecord=RECORD)
    for _ in range(2):
        load_batch(store, "reviews", batch.json(landing).select("*", "_metadata"), "2024-06-01 05:00:00", 1)
    assert store.read_raw("reviews").count() == 2 and store.read_quarantine("reviews").count() == 1


def test_wrong_widths_are_loaded_and_reported(spark):
    store, landing = Store(spark, new_dir("store")), new_dir("landing")
    _write(landing, "a.csv", "h\n1,Inn,Rome,3,9\n2,Inn\n3,Inn,Rome,3,9,more\n")
    ingest_feed(store, "hotels", landing, "2024-06-01 05:00:00")
    assert sorted((r.hotelid, r.rooms) for r in store.read_raw("hotels").fillna("-").collect()) == [
        ("1", "9"), ("2", "-"), ("3", "9")]
    reports = store.read_quarantine("hotels").orderBy("key_text").collect()
    assert [(r.key_text, r.reason, r.record) for r in reports] == [("2", WIDTH, "2,Inn"), ("3", WIDTH, "3,Inn,Rome,3,9,more")]


def test_landing_stays_short_over_fifty_deliveries(spark):
    store, landing, archive = Store(spark, new_dir("store")), new_dir("landing"), new_dir("archive")
    for i in range(50):
        text = "h\n%d,Inn,Rome,3,9\n" % i if i % 10 else "h\n%d,Inn\n" % i
        _write(landing, f"{i:02d}.csv", text)
    ingest_feed(store, "hotels", landing, "2024-06-01 05:00:00", max_files=1, archive=archive)
    assert store.read_raw("hotels").count() == 50 and store.read_quarantine("hotels").count() == 5
    _write(landing, "last.csv", "h\n50,Inn,Rome,3,9\n")
    ingest_feed(store, "hotels", landing, "2024-06-02 05:00:00", archive=archive)
    assert store.read_raw("hotels").count() == 51
    left = [f for f in os.listdir(landing) if f.endswith(".csv")]
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".csv")]
    assert len(left) <= 3 and len(left) + len(moved) == 51
