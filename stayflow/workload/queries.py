"""Registered queries: one per operator, each over whole tables, with its plain-SQL twin."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow import functions as fn
from stayflow.functions.parse import AMOUNT_SENTINELS, FILE_NULL_TOKENS
from stayflow.operators.dedup import dedup_latest, latest_first, require_key
from stayflow.operators.joins import join_preaggregated
from stayflow.operators.keys import assign_keys
from stayflow.operators.lookup import lookup_current_sk, unmatched
from stayflow.operators.merge import merge_upsert
from stayflow.operators.scd2 import scd2_apply, scd2_expire, scd2_insert
from stayflow.plans import core, marts, reports
from stayflow.plans.run import StepResult, read_run_log, recent_runs, run_pipeline, together
from stayflow.plans.staging import BAD_KEY, STAGERS
from stayflow.schemas import FEED_KEYS, FEED_SCHEMAS, RAW_SCHEMAS
from stayflow.session import require
from stayflow.sources.changes import feeds_ready, latest_batch, read_changes
from stayflow.sources.files import (
    DAMAGE,
    LINES,
    OBJECT,
    RECORD,
    WIDTH,
    null_tokens,
    read_csv_feed,
    read_json_feed,
    timestamp_literal,
    with_load_metadata,
)
from stayflow.sources.store import Store
from stayflow.streaming.ingest import ingest_feed
from stayflow.workload import landing, oracle
from stayflow.workload.feeds import FIRST_LOAD, RUN_TIMES, SECOND_LOAD, run_sql
from stayflow.workload.layers import LAST_BATCH, Layers, layers_for, plain
from stayflow.workload.oracle import shown, with_parts

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    query: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None) -> Callable[[Callable[[Layers], DataFrame]], object]:
    def add(build: Callable[[Layers], DataFrame]) -> object:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(layers_for(require(spark), sf_dir)))

        REGISTRY[name] = Entry(query, sql)
        return build

    return add


# -- column functions: (id, v) from a table, with the function's result ----------------


def register_function(
    name: str, source: str, apply: Callable[[Column], Column], sql: Callable[[str], str], out: str = ""
) -> None:
    """``source`` is a shared text yielding ``id`` and the input text ``v``."""
    tables = {t: t for t in oracle.TABLES}
    result = f"({sql('v')}){out}"
    twin = f"select id, v, {result} as result from ({source.format(**tables)}) x"

    @register(name, twin)
    def _(layers: Layers) -> DataFrame:
        texts = run_sql(layers.spark, layers.sf_dir, source)
        return texts.select("id", "v", apply(F.col("v")).alias("result"))


def variants(key: str, table: str, *texts: str) -> str:
    """Shared text: every row of a table with one of several spellings of its key."""
    cases = " ".join(f"when {i} then {text}" for i, text in enumerate(texts))
    return f"select {key} as id, case {key} % {len(texts)} {cases} end as v from {{{table}}}"


ORDER_KEY = "cast(o_orderkey as string)"
NUMBERS = variants(
    "o_orderkey",
    "orders",
    ORDER_KEY,
    f"concat(' ', {ORDER_KEY}, ' ')",
    f"concat({ORDER_KEY}, '.5')",
    f"concat('-', {ORDER_KEY}, '.5')",
    f"concat('0', {ORDER_KEY})",
    f"concat('n', {ORDER_KEY})",
    "''",
    "cast(null as string)",
    "'99999999999999999999'",
)
AMOUNTS = variants(
    "o_orderkey",
    "orders",
    "cast(cast(o_totalprice as decimal(12,2)) as string)",
    f"concat({ORDER_KEY}, '.456')",
    f"concat('-', {ORDER_KEY}, '.005')",
    f"concat('1,', {ORDER_KEY})",
    "'99999999999.00'",
    "' NaN '",
    "'??'",
    "'null'",
    "cast(null as string)",
)
TIMES = variants(
    "o_orderkey",
    "orders",
    "concat(cast(cast(o_orderdate as date) as string), ' 14:05:09')",
    "cast(cast(o_orderdate as date) as string)",
    "'2024-13-45 00:00:00'",
    "concat('on ', cast(cast(o_orderdate as date) as string))",
    "cast(null as string)",
)
FLAGS = variants("o_orderkey", "orders", "' yes '", "'NO'", "'Y'", "o_orderstatus", "''", "cast(null as string)")
BOOLS = variants("o_orderkey", "orders", "'true'", "' FALSE'", "'1'", "o_orderstatus", "cast(null as string)")
NAMES = variants(
    "c_custkey",
    "customer",
    "concat('  ', lower(c_name), '@')",
    "concat('##', c_name, '  o@neil')",
    "concat('o''neil-', lower(c_name))",
    "concat(upper(c_mktsegment), ' & ', c_name)",
    "'###'",
    "cast(null as string)",
)
EMAILS = variants(
    "c_custkey",
    "customer",
    "concat(' ', c_name, ' @Mail.COM ')",
    "concat(c_name, '.mail.com')",
    "'a@b'",
    "'@.'",
    "concat('$', c_mktsegment, '&%@x.y')",
    "cast(null as string)",
)
DIGITS = "lpad(cast(c_custkey as string), 7, '0')"
PHONES = variants(
    "c_custkey",
    "customer",
    f"concat('(555) ', {DIGITS}, ' x12')",
    f"concat('001-555-', {DIGITS})",
    f"concat('+1 555 ', {DIGITS})",
    f"concat('44 1234', {DIGITS})",
    f"concat('ext ', {DIGITS})",
    "'n/a'",
    "''",
    "cast(c_custkey as string)",
    "cast(null as string)",
)
CITIES = (
    "select c_custkey as id, case c_custkey % 5 when 0 then concat(' ', lower(n_name), '#') when 1 then '@@@' "
    "when 2 then '??' when 3 then concat(n_name, ', N/A') else cast(null as string) end as v "
    "from {customer} join {nation} on c_nationkey = n_nationkey"
)
HOTEL_NAMES = variants(
    "s_suppkey", "supplier", "concat('grand-', s_name, ',')", "concat(upper(s_name), '-INN, #1')", "cast(null as string)"
)
SHIFTS = variants(
    "c_custkey",
    "customer",
    "'Night-2'",
    "'day shift!'",
    "concat(c_mktsegment, ' ', cast(c_custkey as string))",
    "''",
    "cast(null as string)",
)
COMMENTS = variants(
    "event_id", "events", "'###'", "concat('  ok & ', upper(event_type), ' ')", "''", "props", "cast(null as string)"
)
SENTIMENTS = variants(
    "event_id", "events", "'positive'", "' NEGATIVE '", "concat('very ', event_type)", "cast(null as string)"
)

register_function("fn_parse_number", NUMBERS, fn.parse_number, oracle.num)
register_function("fn_parse_decimal", AMOUNTS, fn.parse_decimal, oracle.money, "::double")
register_function("fn_parse_timestamp", TIMES, fn.parse_ts, oracle.stamp)
register_function(
    "fn_null_sentinel",
    AMOUNTS,
    lambda c: fn.null_if_sentinel(c, AMOUNT_SENTINELS),
    lambda x: oracle.without(x, "NAN", "NONE", "??", "", "NULL"),
)
register_function("fn_parse_flag", FLAGS, fn.parse_flag, lambda x: oracle.flag(x, "YES", "NO"))
register_function(
    "fn_parse_bool", BOOLS, lambda c: fn.parse_flag(c, "TRUE", "FALSE"), lambda x: oracle.flag(x, "TRUE", "FALSE")
)
register_function("fn_strip_symbols", NAMES, fn.strip_symbols, oracle.drop_chars)
register_function("fn_clean_name", NAMES, fn.clean_name, oracle.label)
register_function("fn_clean_email", EMAILS, fn.clean_email, oracle.email)
register_function("fn_phone_digits", PHONES, fn.phone_digits, oracle.digits)
register_function("fn_normalize_phone", PHONES, fn.normalize_phone, oracle.phone)
register_function("fn_clean_city", CITIES, fn.clean_city, oracle.city)
register_function("fn_clean_hotel_name", HOTEL_NAMES, fn.clean_hotel_name, oracle.hotel_name)
register_function("fn_clean_shift", SHIFTS, fn.clean_shift, oracle.shift)
register_function("fn_initcap", NAMES, fn.initcap_words, oracle.caps)
register_function(
    "fn_initcap_delimiters",
    NAMES,
    lambda c: fn.initcap_words(c, " '-"),
    lambda x: (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '[^ ''-]+|[ ''-]+'), "
        "lambda w: concat(upper(w[1:1]), w[2:])), '')"
    ),
)
register_function("fn_clean_comments", COMMENTS, fn.clean_comments, oracle.comments)
register_function("fn_clean_sentiment", SENTIMENTS, fn.clean_sentiment, oracle.sentiment)


# -- sources and sinks -------------------------------------------------------------------


def _tokens_out(feed: str, source: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in FILE_NULL_TOKENS)
    return ", ".join(f"if({c} in ({tokens}), null, {c}) as {c}" for c in FEED_SCHEMAS[feed].fieldNames())


def tokens_sql(feed: str, source: str, extra: str = "") -> str:
    return with_parts(f"select {_tokens_out(feed, source)}{extra} from {source}")


@register("src_null_tokens", tokens_sql("bookings", "bookings_raw", ", _batch_id"))
def _(x: Layers) -> DataFrame:
    cols = FEED_SCHEMAS["bookings"].fieldNames()
    return null_tokens(x.raw("bookings"), cols).select(*cols, "_batch_id")


@register("src_csv_feed", tokens_sql("customers", "customers_raw1"))
def _(x: Layers) -> DataFrame:
    path = x.fresh_path("customers")
    landing.land(x.raw("customers", 1), "customers", path)
    return read_csv_feed(x.spark, path, FEED_SCHEMAS["customers"]).select(*FEED_SCHEMAS["customers"].fieldNames())


@register("src_json_feed", tokens_sql("reviews", "reviews_raw1"))
def _(x: Layers) -> DataFrame:
    path = x.fresh_path("reviews")
    landing.land(x.raw("reviews", 1), "reviews", path)
    return read_json_feed(x.spark, path, FEED_SCHEMAS["reviews"]).select(*FEED_SCHEMAS["reviews"].fieldNames())


@register(
    "src_load_metadata",
    with_parts(
        f"select hotelid, timestamp '{FIRST_LOAD}' as _loaded_at, true as from_landing, "
        "1::bigint as _batch_id from hotels_raw1"
    ),
)
def _(x: Layers) -> DataFrame:
    path = x.fresh_path("hotels")
    landing.land(x.raw("hotels", 1), "hotels", path)
    rows = with_load_metadata(read_csv_feed(x.spark, path, FEED_SCHEMAS["hotels"]), FIRST_LOAD, 1)
    inside = F.contains("_filename", F.lit(path.removeprefix("file:")))
    return rows.select("hotelid", "_loaded_at", inside.alias("from_landing"), "_batch_id")


@register(
    "ingest_incremental",
    with_parts(
        f"select {_tokens_out('bookings', '')}, _batch_id, "
        f"if(_batch_id = 1, timestamp '{FIRST_LOAD}', timestamp '{SECOND_LOAD}') as _loaded_at from bookings_raw"
    ),
)
def _(x: Layers) -> DataFrame:
    store, files = Store(x.spark, x.fresh_path("store")), x.fresh_path("landing")
    for batch, loaded in ((1, FIRST_LOAD), (2, SECOND_LOAD)):
        landing.land(x.raw("bookings", batch), "bookings", files)
        ingest_feed(store, "bookings", files, loaded)
    ingest_feed(store, "bookings", files, "2024-06-03 05:00:00")
    return store.read_raw("bookings").select(*FEED_SCHEMAS["bookings"].fieldNames(), "_batch_id", "_loaded_at")


# Line breaks and quotes in the names of every third customer.
_BROKEN_NAMES = (
    "select cast(c_custkey as string) as customerid, case when c_custkey % 3 = 0 "
    "then concat(c_name, {nl}, 'the \"', c_mktsegment, '\",', {nl}) else c_name end as customername, "
    "c_phone_like as email, cast(c_nationkey as string) as phone, c_mktsegment as city from "
    "(select *, concat(lower(c_name), '@x.y') as c_phone_like from {customer}) c"
)


@register("src_csv_line_breaks", _BROKEN_NAMES.format(nl="chr(10)", customer="customer"))
def _(x: Layers) -> DataFrame:
    rows = run_sql(x.spark, x.sf_dir, _BROKEN_NAMES.replace("{nl}", "chr(10)"))
    path = x.fresh_path("customers")
    landing.land(rows, "customers", path)
    return read_csv_feed(x.spark, path, FEED_SCHEMAS["customers"], multi_line=True).select(*rows.columns)


# Hotel records of three to seven fields.
_WIDTHS = (
    "select s_suppkey, s_name, concat_ws(',', cast(s_suppkey as string), s_name, 'rome'"
    ", case when s_suppkey % 5 > 0 then '3' end, case when s_suppkey % 5 > 1 then '40' end"
    ", case when s_suppkey % 5 > 2 then 'more' end, case when s_suppkey % 5 > 3 then 'still' end) as line from {supplier}"
)


def write_lines(rows: DataFrame, path: str) -> None:
    """Column ``line`` as it is, under a header in every file."""
    rows.select("line").write.csv(path, header=True, sep="\x01", quote="\x00")


@register(
    "src_csv_widths",
    "select cast(s_suppkey as varchar) as hotelid, s_name as hotelname, 'rome' as city, "
    "if(s_suppkey % 5 > 0, '3', null) as stars, if(s_suppkey % 5 > 1, '40', null) as rooms, "
    f"if(s_suppkey % 5 = 2, null, '{WIDTH}') as damage, if(s_suppkey % 5 = 2, null, line) as record "
    f"from ({_WIDTHS.format(supplier='supplier')}) lines",
)
def _(x: Layers) -> DataFrame:
    path = x.fresh_path("hotels")
    write_lines(run_sql(x.spark, x.sf_dir, _WIDTHS), path)
    rows = read_csv_feed(x.spark, path, FEED_SCHEMAS["hotels"])
    return rows.select(*FEED_SCHEMAS["hotels"].fieldNames(), F.col(DAMAGE).alias("damage"), F.col(RECORD).alias("record"))


# An array of one object in every line; every seventh event's is cut off.
_OBJECT_LINES = (
    "select event_id, event_type, case when event_id % 7 = 3 then substr(object, 1, length(object) - 3) else object end as line "
    "from (select event_id, event_type, concat('[{{\"reviewid\":', cast(event_id as string), ',\"sentiment\":\"', "
    "event_type, '\"}}]') as object from {events}) o"
)


@register(
    "src_json_lines",
    "select if(event_id % 7 = 3, null, cast(event_id as varchar)) as reviewid, "
    "if(event_id % 7 = 3, null, event_type) as sentiment, "
    f"if(event_id % 7 = 3, '{OBJECT}', null) as damage, if(event_id % 7 = 3, line, null) as record "
    f"from ({_OBJECT_LINES.format(events='events')}) lines",
)
def _(x: Layers) -> DataFrame:
    path = x.fresh_path("reviews")
    run_sql(x.spark, x.sf_dir, _OBJECT_LINES).select("line").write.text(path)
    rows = read_json_feed(x.spark, path, FEED_SCHEMAS["reviews"], layout=LINES)
    return rows.select("reviewid", "sentiment", F.col(DAMAGE).alias("damage"), F.col(RECORD).alias("record"))


@register(
    "ingest_quarantine",
    "select 'hotels' as feed, key_text, reason, record from (select cast(s_suppkey as varchar) as key_text, "
    f"'{WIDTH}' as reason, line as record from ({_WIDTHS.format(supplier='supplier')}) h where s_suppkey % 5 <> 2) "
    f"union all select 'reviews', null, '{OBJECT}', line from ({_OBJECT_LINES.format(events='events')}) r "
    "where event_id % 7 = 3",
)
def _(x: Layers) -> DataFrame:
    store, files = Store(x.spark, x.fresh_path("store")), x.fresh_path("landing")
    write_lines(run_sql(x.spark, x.sf_dir, _WIDTHS), f"{files}/hotels")
    run_sql(x.spark, x.sf_dir, _OBJECT_LINES).select("line").write.text(f"{files}/reviews")
    for feed in ("hotels", "reviews"):
        ingest_feed(store, feed, f"{files}/{feed}", FIRST_LOAD, layout=LINES)
    both = store.read_quarantine("hotels").unionByName(store.read_quarantine("reviews"))
    return both.select("feed", "key_text", "reason", "record")


@register("sink_full_refresh", shown("hotels_stg2"))
def _(x: Layers) -> DataFrame:
    store = Store(x.spark, x.fresh_path("store"))
    for batch in (1, 2):
        run = store.begin(batch, RUN_TIMES[batch])
        run.replace("stg_hotels", x.staged("hotels", batch))
        run.commit({})
    return store.read("stg_hotels")


# -- change feed -------------------------------------------------------------------------


def _store_with(x: Layers, feeds: list[str], batches: tuple[int, ...]) -> Store:
    store = Store(x.spark, x.fresh_path("store"))
    for batch in batches:
        append(x, store, feeds, batch)
    return store


def append(x: Layers, store: Store, feeds: Iterable[str], batch: int) -> None:
    together(x.spark, [lambda f=feed: store.append_raw(f, x.raw(f, batch)) for feed in feeds])


@register("cdc_append_only", shown("bookings_raw2"))
def _(x: Layers) -> DataFrame:
    raw = _store_with(x, ["bookings"], (1, 2)).read_raw("bookings")
    return read_changes(raw, 1, latest_batch(raw, 1))


@register(
    "cdc_offset_advance",
    with_parts(
        " union all ".join(
            f"select '{f}' as feed, (select count(*) from {f}_raw1) as unread_first, "
            f"(select count(*) from {f}_raw2) as unread_after_commit"
            for f in FEED_SCHEMAS
        )
    ),
)
def _(x: Layers) -> DataFrame:
    feeds = list(FEED_SCHEMAS)
    store = _store_with(x, feeds, (1,))

    def unread(feed: str, name: str) -> DataFrame:
        raw, low = store.read_raw(feed), store.state().offsets.get(feed, 0)
        rows = read_changes(raw, low, latest_batch(raw, low))
        return rows.agg(F.count(F.lit(1)).alias(name)).select(F.lit(feed).alias("feed"), name)

    first = [unread(f, "unread_first") for f in feeds]
    store.begin(1, RUN_TIMES[1]).commit({f: latest_batch(store.read_raw(f), 0) for f in feeds})
    append(x, store, feeds, 2)
    after = [unread(f, "unread_after_commit") for f in feeds]
    both = first[0]
    for part in [*first[1:], *after]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy("feed").agg(
        F.max("unread_first").alias("unread_first"), F.max("unread_after_commit").alias("unread_after_commit")
    )


@register(
    "cdc_has_data",
    with_parts(
        "select "
        + ", ".join(
            f"coalesce((select max(_batch_id) from {f}_raw), 0) > {2 if f == 'bookings' else 1} as {f}_ready"
            for f in FEED_SCHEMAS
        )
    ),
)
def _(x: Layers) -> DataFrame:
    store = _store_with(x, list(FEED_SCHEMAS), (1, 2))
    offsets = {f: 2 if f == "bookings" else 1 for f in FEED_SCHEMAS}
    return feeds_ready({f: store.read_raw(f) for f in FEED_SCHEMAS}, offsets)


# -- deduplication and staging -----------------------------------------------------------

_BY_TEXT = ", ".join(
    f"{c} desc nulls last" for c in ("_loaded_at", "_filename", *FEED_SCHEMAS["bookings"].fieldNames())
)


@register(
    "dedup_latest",
    with_parts(
        "select * from bookings_raw qualify row_number() over "
        f"(partition by bookingid order by {_BY_TEXT}) = 1"
    ),
)
def _(x: Layers) -> DataFrame:
    raw = x.raw("bookings")
    return dedup_latest(raw, [F.col("bookingid")], latest_first(raw))


@register(
    "filter_bad_key",
    with_parts(f"select bookingid, hotelid from bookings_raw where {oracle.num('hotelid')} is not null"),
)
def _(x: Layers) -> DataFrame:
    return require_key(x.raw("bookings"), "hotelid").select("bookingid", "hotelid")


# Spellings of a key, some beyond 64 bits and some that are none.
_KEYS = variants(
    "o_orderkey",
    "orders",
    ORDER_KEY,
    f"concat('12345678901234', lpad({ORDER_KEY}, 10, '0'))",
    f"concat('  00', {ORDER_KEY}, ' ')",
    f"concat('b', {ORDER_KEY})",
    "''",
    "cast(null as string)",
    f"concat('{'9' * 32}', lpad({ORDER_KEY}, 10, '0'))",
)
_KEYS_HERE = _KEYS.format(orders="orders")


def _run_of_keys(x: Layers) -> tuple[Store, list[StepResult]]:
    """A run over bookings with these keys, made once per session and tables folder."""
    with x.locks.setdefault("run_of_keys", threading.Lock()):
        if x.run_of_keys is None:
            store = Store(x.spark, x.fresh_path("store"))
            columns = {c: F.lit(None).cast("string") for c in RAW_SCHEMAS["bookings"].fieldNames()}
            columns |= {"bookingid": F.col("v"), "hotelid": F.col("v"), "_loaded_at": timestamp_literal(FIRST_LOAD)}
            columns |= {"_filename": F.lit("keys"), "_batch_id": F.lit(1)}
            rows = run_sql(x.spark, x.sf_dir, _KEYS).select(*[c.alias(name) for name, c in columns.items()])
            store.append_raw("bookings", rows)
            x.run_of_keys = store, run_pipeline(store, RUN_TIMES[1])
    return x.run_of_keys


@register(
    "stg_wide_keys",
    "select distinct cast(try_cast(v as decimal(38,0)) as varchar) as booking_id, "
    "cast(try_cast(v as decimal(38,0)) as varchar) as hotel_id, "
    f"true as in_fact from ({_KEYS_HERE}) k where try_cast(v as decimal(38,0)) is not null",
)
def _(x: Layers) -> DataFrame:
    store, _ = _run_of_keys(x)
    facts = store.read("fact_bookings").select("booking_id", F.lit(True).alias("in_fact"))
    staged = store.read("stg_bookings").select("booking_id", "hotel_id").join(facts, "booking_id", "left")
    return staged.select(*[F.col(c).cast("string").alias(c) for c in ("booking_id", "hotel_id")], "in_fact")


@register(
    "stage_rejects",
    f"select 'bookings' as feed, '{BAD_KEY}' as reason, v as key_text, 'keys' as _filename, 1::bigint as _batch_id "
    f"from ({_KEYS_HERE}) k where try_cast(v as decimal(38,0)) is null",
)
def _(x: Layers) -> DataFrame:
    store, _ = _run_of_keys(x)
    return store.read("rejects").select("feed", "reason", "key_text", "_filename", "_batch_id")


@register(
    "step_rejects",
    "select 'stg_bookings' as table_name, unnest(['staged', 'rejected', 'damaged']) as measure, "
    "unnest([count(distinct try_cast(v as decimal(38,0))), count(*) filter (where try_cast(v as decimal(38,0)) is null), 0]) "
    f"as n from ({_KEYS_HERE}) k",
)
def _(x: Layers) -> DataFrame:
    _, steps = _run_of_keys(x)
    return step_counts(x, {1: steps}).where("table_name = 'stg_bookings'").drop("run")


def step_counts(x: Layers, runs: dict[int, list[StepResult]]) -> DataFrame:
    """(run, table_name, measure, n): what the steps of runs say they did."""
    rows = [
        (run, table, measure, n)
        for run, steps in runs.items()
        for step in steps
        for table, counts in step.counts.items()
        for measure, n in counts.items()
    ]
    return x.spark.createDataFrame(rows, "run int, table_name string, measure string, n bigint")


STAGED_MONEY = {"bookings": ("total_amount",), "room_rates": ("price", "discounted_price")}

for _feed in STAGERS:

    @register(f"stg_{_feed}", shown(f"{_feed}_stg", STAGED_MONEY.get(_feed, ())))
    def _(x: Layers, feed: str = _feed) -> DataFrame:
        return x.stage_all(feed)


# -- comparison, lookup and anti joins ---------------------------------------------------

_PAIRS = "customers_stg1 a join customers_stg2 b using (customer_id)"


@register(
    "fn_null_safe_diff",
    with_parts(
        f"select customer_id, {oracle.differs('a', 'b', ['email', 'city'])} as is_changed, "
        f"not {oracle.differs('a', 'b', ['email', 'phone'])} as same_null_safe, "
        f"(a.email = b.email and a.phone = b.phone) as same_strict from {_PAIRS}"
    ),
)
def _(x: Layers) -> DataFrame:
    a, b = x.staged("customers", 1).alias("a"), x.staged("customers", 2).alias("b")
    return a.join(b, F.col("a.customer_id") == F.col("b.customer_id")).select(
        F.col("a.customer_id").alias("customer_id"),
        fn.changed("a", "b", ["email", "city"]).alias("is_changed"),
        fn.same("a", "b", ["email", "phone"]).alias("same_null_safe"),
        fn.same("a", "b", ["email", "phone"], null_safe=False).alias("same_strict"),
    )


@register(
    "lookup_current_sk",
    with_parts(
        "select booking_id, customer_id, customer_sk from bookings_stg left join "
        "(select customer_id, customer_sk from customers_dim2 where is_current) c using (customer_id)"
    ),
)
def _(x: Layers) -> DataFrame:
    bookings = x.staged_all("bookings").select("booking_id", "customer_id")
    dim = x.versions("customers")
    return lookup_current_sk(bookings, dim, "customer_id", "customer_sk", "booking_id")


_TRACKED = list(core.CUSTOMERS.tracked)
_ALIKE = " and ".join(f"s.{c} = d.{c}" for c in _TRACKED)


@register(
    "anti_join_strict",
    with_parts(
        f"select s.* from customers_stg2 s anti join customers_dim1 d on s.customer_id = d.customer_id and {_ALIKE}"
    ),
)
def _(x: Layers) -> DataFrame:
    return unmatched(x.staged("customers", 2), x.versions("customers", 1), ["customer_id", *_TRACKED])


@register(
    "anti_join_null_safe",
    with_parts(
        "select s.* from customers_stg2 s left join customers_dim1 d using (customer_id) "
        f"where d.customer_id is null or {oracle.differs('s', 'd', _TRACKED)}"
    ),
)
def _(x: Layers) -> DataFrame:
    dim = x.versions("customers", 1)
    return unmatched(x.staged("customers", 2), dim, ["customer_id", *_TRACKED], null_safe=True)


@register(
    "join_preaggregated",
    with_parts(
        "select h.hotel_id, b.n as bookings, b.revenue::double as revenue, s.n as staff from hotels_stg h left join "
        "(select hotel_id, count(*) as n, sum(total_amount) as revenue from bookings_stg group by 1) b "
        "using (hotel_id) left join (select hotel_id, count(*) as n from staff_stg group by 1) s using (hotel_id)"
    ),
)
def _(x: Layers) -> DataFrame:
    booked = (
        x.staged_all("bookings")
        .groupBy("hotel_id")
        .agg(F.count(F.lit(1)).alias("bookings"), F.sum("total_amount").alias("revenue"))
    )
    employed = x.staged_all("staff").groupBy("hotel_id").agg(F.count(F.lit(1)).alias("staff"))
    hotels = x.staged_all("hotels").select("hotel_id")
    return join_preaggregated(hotels, [(booked, "hotel_id"), (employed, "hotel_id")])


# -- merge and dimensions ----------------------------------------------------------------


@register(
    "merge_upsert",
    with_parts(
        "select coalesce(t.room_rate_id, s.room_rate_id) as room_rate_id, "
        "coalesce(t.room_type, s.room_type) as room_type, "
        "(case when s.room_rate_id is null then t.price when t.room_rate_id is null then s.price "
        f"when {oracle.differs('t', 's', ['price', 'discounted_price'])} then s.price else t.price end)::double as price, "
        "(case when s.room_rate_id is null then t.discounted_price when t.room_rate_id is null "
        f"or {oracle.differs('t', 's', ['price', 'discounted_price'])} then s.discounted_price "
        "else t.discounted_price end)::double as discounted_price "
        "from room_rates_stg1 t full join room_rates_stg2 s on t.room_rate_id = s.room_rate_id"
    ),
)
def _(x: Layers) -> DataFrame:
    cols = ["room_rate_id", "room_type", "price", "discounted_price"]
    old, new = x.staged("room_rates", 1).select(*cols), x.staged("room_rates", 2).select(*cols)
    prices = ["price", "discounted_price"]
    return merge_upsert(old, new, ["room_rate_id"], prices, prices)


@register("dim_hotels_scd1", shown("hotels_dim2"))
def _(x: Layers) -> DataFrame:
    return x.apply_hotels(LAST_BATCH)


@register("scd2_expire", shown("customers_old2"))
def _(x: Layers) -> DataFrame:
    dim = x.versions("customers", 1)
    return scd2_expire(dim, x.staged("customers", 2), core.CUSTOMERS, x.ts(2))


@register("scd2_insert", shown("customers_new2"))
def _(x: Layers) -> DataFrame:
    dim, last = x.versions("customers", 1), x.last_key("customers", 1)
    return scd2_insert(dim, x.staged("customers", 2), core.CUSTOMERS, x.ts(2), last, x.fresh_path("opened"))


@register("scd2_apply", shown("room_rates_dim2", ("price", "discounted_price")))
def _(x: Layers) -> DataFrame:
    dim, last = x.versions("room_rates", 1), x.last_key("room_rates", 1)
    src = x.staged("room_rates", 2)
    return scd2_apply(dim, src, core.ROOM_RATES, x.ts(2), last, x.fresh_path("opened"))


@register(
    "surrogate_keys",
    with_parts("select 1000 + row_number() over (order by booking_id) as booking_sk, booking_id from bookings_stg"),
)
def _(x: Layers) -> DataFrame:
    rows = x.staged_all("bookings").select("booking_id")
    return assign_keys(rows, [F.col("booking_id")], "booking_sk", 1000, x.fresh_path("keys"))


_DIM_MONEY = {"room_rates": ("price", "discounted_price")}
for _feed in core.VERSIONED:

    @register(f"dim_{_feed}_scd2", shown(f"{_feed}_dim2", _DIM_MONEY.get(_feed, ())))
    def _(x: Layers, feed: str = _feed) -> DataFrame:
        return x.apply_versions(feed, LAST_BATCH)


# -- facts -------------------------------------------------------------------------------

_BOOKING_DATES = ("checkin_date", "checkout_date")


@register("fact_bookings_merge", shown("bookings_fact2", ("total_amount",), _BOOKING_DATES))
def _(x: Layers) -> DataFrame:
    return x.apply_fact("bookings", LAST_BATCH)


@register("fact_reviews_merge", shown("reviews_fact2"))
def _(x: Layers) -> DataFrame:
    return x.apply_fact("reviews", LAST_BATCH)


@register(
    "fact_late_arrival",
    with_parts(
        "select n.booking_id, o.total_amount::double as amount_before, n.total_amount::double as amount_after, "
        "n.created_at, n.updated_at from bookings_fact2 n join bookings_fact1 o using (booking_id) "
        "where n.updated_at is not null"
    ),
)
def _(x: Layers) -> DataFrame:
    before = x.fact("bookings", 1)
    src = x.staged("bookings", 2)
    after = core.load_fact_bookings(before, src, x.versions("customers", 2), x.ts(2))
    return after.where("updated_at is not null").join(
        before.select("booking_id", F.col("total_amount").alias("amount_before")), "booking_id"
    ).select(
        "booking_id", "amount_before", F.col("total_amount").alias("amount_after"), "created_at", "updated_at"
    )


# -- marts and reports -------------------------------------------------------------------


@register(
    "agg_conditional_count",
    with_parts(
        "select hotel_id, count(*) as bookings, count(total_amount) as priced, "
        "sum(case when is_high_value then 1 else 0 end)::bigint as high_value, "
        "count(*) filter (where is_high_value is null) as unknown from bookings_stg group by hotel_id"
    ),
)
def _(x: Layers) -> DataFrame:
    return (
        x.staged_all("bookings")
        .groupBy("hotel_id")
        .agg(
            F.count(F.lit(1)).alias("bookings"),
            F.count("total_amount").alias("priced"),
            fn.count_when(F.col("is_high_value")).alias("high_value"),
            fn.count_when(F.col("is_high_value").isNull()).alias("unknown"),
        )
    )


@register("mart_revenue", shown("mart_revenue"))
def _(x: Layers) -> DataFrame:
    return marts.mart_revenue(x.fact("bookings"), x.hotels())


@register("mart_occupancy", shown("mart_occupancy"))
def _(x: Layers) -> DataFrame:
    return marts.mart_occupancy(
        x.fact("bookings"), x.hotels(), x.versions("room_rates")
    )


@register("mart_customer_segments", shown("mart_customer_segments"))
def _(x: Layers) -> DataFrame:
    return marts.mart_customer_segments(x.fact("bookings"), x.versions("customers"))


@register("mart_satisfaction", shown("mart_satisfaction"))
def _(x: Layers) -> DataFrame:
    return marts.mart_satisfaction(x.fact("reviews"), x.fact("bookings"), x.hotels())


@register("mart_staff", shown("mart_staff"))
def _(x: Layers) -> DataFrame:
    return marts.mart_staff(x.versions("staff"), x.hotels())


@register("mart_hotel_performance", shown("performance"))
def _(x: Layers) -> DataFrame:
    return x.build_performance()


@register("performance_band", shown("banded"))
def _(x: Layers) -> DataFrame:
    return reports.performance_band(x.performance())


@register(
    "band_distribution",
    with_parts(
        "select performance_band, n as hotel_count, "
        f"{oracle.pct('n', '(select count(*) from performance)')} as hotel_pct "
        "from (select performance_band, count(*) as n from banded group by 1) c"
    ),
)
def _(x: Layers) -> DataFrame:
    return reports.band_distribution(x.performance())


@register(
    "kpi_cards",
    with_parts(
        "select revenue::double as total_revenue, n as total_bookings, "
        f"{oracle.pct('high', 'n')} as high_value_pct, "
        "(select sum(rating)::double / count(rating) from reviews_fact2) as avg_rating "
        "from (select sum(total_amount) as revenue, count(*) as n, "
        "count(*) filter (where is_high_value) as high from bookings_fact2) b"
    ),
)
def _(x: Layers) -> DataFrame:
    return reports.kpi_cards(x.fact("bookings"), x.fact("reviews"))


@register(
    "revenue_by_city",
    with_parts(
        "select city, sum(total_revenue::decimal(22,2))::double as total_revenue, "
        "sum(total_bookings)::bigint as total_bookings from performance group by city"
    ),
)
def _(x: Layers) -> DataFrame:
    return reports.revenue_by_city(x.performance())


@register(
    "rating_revenue_points",
    with_parts("select hotel_id, hotel_name, avg_rating, total_revenue, performance_band from banded"),
)
def _(x: Layers) -> DataFrame:
    return reports.rating_revenue_points(x.performance())


_RANKED = (
    "select hotel_id, hotel_name, city, stars, total_revenue, avg_rating, performance_band, "
    "rank() over (order by total_revenue desc nulls last) as revenue_rank from banded"
)


@register("hotel_ranking", with_parts(_RANKED))
def _(x: Layers) -> DataFrame:
    return reports.hotel_ranking(x.performance(), x.fresh_path("ranks"))


@register("hotel_ranking_top", with_parts(f"{_RANKED} order by total_revenue desc nulls last, hotel_id limit 10"))
def _(x: Layers) -> DataFrame:
    return reports.hotel_ranking(x.performance(), x.fresh_path("ranks"), k=10)


@register(
    "mart_filtered",
    with_parts("select * from performance where stars in (3, 4, 5) and city in ('Nation_6', 'Nation_9', 'Nation_11', 'Nation_19')"),
)
def _(x: Layers) -> DataFrame:
    return reports.filter_mart(x.performance(), cities=["Nation_6", "Nation_9", "Nation_11", "Nation_19"], stars=[3, 4, 5])


@register(
    "portfolio_average",
    with_parts(
        "select sum(total_revenue::decimal(22,2))::double / count(total_revenue) as avg_revenue_per_hotel "
        "from performance"
    ),
)
def _(x: Layers) -> DataFrame:
    return reports.portfolio_average(x.performance())


# -- whole runs --------------------------------------------------------------------------


def _two_runs(x: Layers) -> Store:
    """A store after both deliveries have run, made once per session and tables folder."""
    with x.locks.setdefault("two_runs", threading.Lock()):
        if x.two_runs is None:
            store, steps = Store(x.spark, x.fresh_path("store")), {}
            for batch in (1, 2):
                append(x, store, FEED_SCHEMAS, batch)
                steps[batch] = run_pipeline(store, RUN_TIMES[batch])
            x.two_runs = store, steps
    return x.two_runs[0]


def _counted(run: int, table: str, **counts: str) -> str:
    return " union all ".join(
        f"select {run} as run, '{table}' as table_name, '{measure}' as measure, ({count})::bigint as n"
        for measure, count in counts.items()
    )


def _step_counts_sql() -> str:
    parts = []
    for batch in (1, 2):
        for feed, key in FEED_KEYS.items():
            bad = f"select count(*) from {feed}_raw{batch} where try_cast({key} as decimal(38,0)) is null"
            parts.append(_counted(batch, f"stg_{feed}", staged=f"select count(*) from {feed}_stg{batch}", rejected=bad, damaged="select 0"))
    changed = oracle.differs("d", "s", ["hotel_name", "city", "stars", "rooms"])
    parts.append(_counted(1, "dim_hotels", inserted="select count(*) from hotels_dim1", updated="select 0"))
    parts.append(
        _counted(
            2,
            "dim_hotels",
            inserted="select count(*) from hotels_stg2 s anti join hotels_dim1 d using (hotel_id)",
            updated=f"select count(*) from hotels_stg2 s join hotels_dim1 d using (hotel_id) where {changed}",
        )
    )
    for feed in core.VERSIONED:
        parts.append(_counted(1, f"dim_{feed}", inserted=f"select count(*) from {feed}_dim1", expired="select 0"))
        closed = f"select count(*) from {feed}_old2 where not is_current"
        parts.append(_counted(2, f"dim_{feed}", inserted=f"select count(*) from {feed}_new2", expired=closed))
    for feed, key in (("bookings", "booking_id"), ("reviews", "review_id")):
        parts.append(_counted(1, f"fact_{feed}", inserted=f"select count(*) from {feed}_fact1", updated="select 0"))
        new = f"select count(*) from {feed}_src2 s anti join {feed}_fact1 f using ({key})"
        late = f"select count(*) from {feed}_fact2 where updated_at is not null"
        parts.append(_counted(2, f"fact_{feed}", inserted=new, updated=late))
    for mart in ("mart_revenue", "mart_occupancy", "mart_customer_segments", "mart_satisfaction", "mart_staff"):
        parts.append(_counted(2, mart, rows=f"select count(*) from {mart}"))
    parts.append(_counted(2, "mart_hotel_performance", rows="select count(*) from performance"))
    return with_parts(" union all ".join(parts))


@register("step_counts", _step_counts_sql())
def _(x: Layers) -> DataFrame:
    _two_runs(x)
    # The marts of the first run have no twin.
    return step_counts(x, x.two_runs[1]).where("run = 2 or table_name not like 'mart%'")


@register("pipeline_two_batches", shown("performance"))
def _(x: Layers) -> DataFrame:
    return _two_runs(x).read("mart_hotel_performance")


def register_run_table(table: str, like: str) -> None:
    """A table of the run against the SQL of the operator that makes it."""

    @register(f"pipeline_{table}", REGISTRY[like].sql)
    def _(x: Layers) -> DataFrame:
        return _two_runs(x).read(table)


register_run_table("dim_hotels", "dim_hotels_scd1")
for _feed in core.VERSIONED:
    register_run_table(f"dim_{_feed}", f"dim_{_feed}_scd2")
for _fact in ("fact_bookings", "fact_reviews"):
    register_run_table(_fact, f"{_fact}_merge")
for _mart in ("mart_revenue", "mart_occupancy", "mart_customer_segments", "mart_satisfaction", "mart_staff"):
    register_run_table(_mart, _mart)


@register(
    "run_history",
    "select unnest(['load_staging', 'load_dimensions', 'load_facts', 'refresh_marts']) as name, "
    f"'SUCCEEDED' as state, timestamp '{RUN_TIMES[LAST_BATCH]}' as scheduled_time, null::varchar as error_message",
)
def _(x: Layers) -> DataFrame:
    log = read_run_log(_two_runs(x))
    recent = recent_runs(log, "2024-06-02 12:00:00", hours=24)
    return recent.select("name", "state", "scheduled_time", "error_message").orderBy(
        F.col("scheduled_time").desc(), "name"
    )
