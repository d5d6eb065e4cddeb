"""The six feeds derived from the provided star-schema tables, as two deliveries.

The texts below run unchanged on Spark and on the checking engine: ``{name}`` stands for a
table or an earlier delivery. They are deliberately dirty in the ways the cleaning rules
handle. The second delivery corrects, repeats and adds rows by key arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayflow.schemas import FEED_SCHEMAS

TABLES = ("orders", "lineitem", "customer", "nation", "supplier", "events", "part")

FIRST_LOAD, FIRST_RUN = "2024-06-01 05:00:00", "2024-06-01 06:00:00"
SECOND_LOAD, SECOND_RUN = "2024-06-02 05:00:00", "2024-06-02 06:00:00"
SECOND_LOAD_EARLIER = "2024-06-02 04:00:00"
LOAD_TIMES = {1: FIRST_LOAD, 2: SECOND_LOAD}
RUN_TIMES = {1: FIRST_RUN, 2: SECOND_RUN}

FIRST_DELIVERY = {
    # A booking is an order, its hotel the order's lowest supplier (none without line items).
    "bookings": """
select cast(o_orderkey as string) as bookingid, cast(o_custkey as string) as customerid,
  cast(hotel as string) as hotelid,
  case when o_orderkey % 53 = 0 then cast(cast(o_orderdate as date) as string)
       else concat(cast(cast(o_orderdate as date) as string), ' 14:00:00') end as checkindate,
  concat(cast(cast(o_orderdate as date) + (cast(o_orderkey % 14 as int) + 1) as string), ' 10:00:00') as checkoutdate,
  case when o_orderkey % 97 = 0 then 'NaN' when o_orderkey % 89 = 0 then '??'
       else cast(cast(cast(o_totalprice as decimal(12,2)) * 0.01 as decimal(10,2)) as string) end as totalamount,
  cast(o_orderkey % 14 + 1 as string) as stayduration,
  case when o_orderkey % 41 = 0 then 'maybe' when o_totalprice >= 250000 then 'Yes' else ' no ' end as highvaluebooking
from {orders} left join (select l_orderkey, min(l_suppkey) as hotel from {lineitem} group by l_orderkey) l
  on o_orderkey = l_orderkey""",
    "customers": """
select cast(c_custkey as string) as customerid, concat('  ', lower(c_name), '@') as customername,
  case when c_custkey % 19 = 0 then null when c_custkey % 13 = 0 then 'broken mail'
       else concat('User', cast(c_custkey as string), '# @Mail.com') end as email,
  case when c_custkey % 5 = 0 then concat('001-555-', lpad(cast(c_custkey as string), 7, '0'))
       when c_custkey % 5 = 1 then concat('(555) ', lpad(cast(c_custkey as string), 7, '0'), ' x12')
       when c_custkey % 5 = 2 then concat('+1 555 ', lpad(cast(c_custkey as string), 7, '0'))
       when c_custkey % 5 = 3 then 'n/a' else cast(c_custkey as string) end as phone,
  case when c_custkey % 17 = 0 then '@@@' when c_custkey % 23 = 0 then '??'
       else concat('#', lower(n_name)) end as city
from {customer} join {nation} on c_nationkey = n_nationkey""",
    "hotels": """
select cast(s_suppkey as string) as hotelid, concat('grand-', s_name, ',') as hotelname,
  concat(lower(n_name), '&') as city, cast(s_nationkey % 5 + 1 as string) as stars,
  case when s_suppkey % 29 = 0 then 'many' else cast(s_suppkey % 200 + 20 as string) end as rooms
from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "staff": """
select cast(c_custkey as string) as staffid,
  cast(c_custkey % (select count(*) from {supplier}) as string) as hotelid,
  concat('#', lower(c_name)) as staffname, concat(lower(c_mktsegment), '%') as role,
  case when c_nationkey % 3 = 0 then 'Day-1' when c_nationkey % 3 = 1 then 'Night#' else ' evening ' end as shift
from {customer}""",
    "reviews": """
select cast(event_id as string) as reviewid, cast(event_id as string) as bookingid,
  cast(user_id as string) as customerid,
  case when event_type = 'error' and event_id % 2 = 0 then 'nan'
       else cast(cast(floor(value) as bigint) % 5 + 1 as string) end as rating,
  case when event_id % 7 = 0 then '###' else concat('stay was ', event_type, '$') end as comments,
  case when event_type in ('purchase', 'signup') then 'positive' when event_type = 'error' then ' NEGATIVE '
       when event_id % 31 = 0 then null else 'Neutral' end as sentiment
from {events}""",
    "room_rates": """
select cast(p_partkey as string) as roomrateid,
  cast(p_partkey % (select count(*) from {supplier}) as string) as hotelid,
  concat('#', lower(p_type)) as roomtype,
  case when p_partkey % 37 = 0 then 'nan' else cast(cast(p_retailprice as decimal(12,2)) as string) end as price,
  case when p_size % 3 = 2 then 'unknown' when p_size % 3 = 1 then 'false' else ' True ' end as available,
  cast(cast(cast(p_retailprice as decimal(12,2)) * 0.90 as decimal(10,2)) as string) as discountedprice
from {part}""",
}

# ``{first}`` is the feed's first delivery.
SECOND_DELIVERY = {
    # Late amounts (k % 50), a change that must not be taken over (k % 51), the same key twice
    # with the older copy losing (k % 100 = 1), and new bookings, some of unknown customers.
    "bookings": f"""
select bookingid, customerid, hotelid, checkindate,
  case when k % 51 = 0 then '2031-01-02 10:00:00' else checkoutdate end as checkoutdate,
  case when k % 50 = 0 then concat(cast(k % 900 + 100 as string), '.25')
       when k % 100 = 1 then '345.67' else totalamount end as totalamount,
  stayduration, highvaluebooking, '{SECOND_LOAD}' as loaded
from (select *, cast(bookingid as bigint) as k from {{first}}) a where k % 50 = 0 or k % 51 = 0 or k % 100 = 1
union all
select bookingid, customerid, hotelid, checkindate, checkoutdate, '1.00' as totalamount,
  stayduration, highvaluebooking, '{SECOND_LOAD_EARLIER}' as loaded
from (select *, cast(bookingid as bigint) as k from {{first}}) b where k % 100 = 1
union all
select cast(k + 1 + (select max(cast(bookingid as bigint)) from {{first}}) as string) as bookingid,
  case when k % 3 = 0 then concat('9', lpad(customerid, 9, '0')) else customerid end as customerid,
  hotelid, checkindate, checkoutdate, totalamount, stayduration, highvaluebooking, '{SECOND_LOAD}' as loaded
from (select *, cast(bookingid as bigint) as k from {{first}}) c where k % 75 = 2""",
    "customers": f"""
select customerid, customername,
  case when k % 38 = 0 then concat('User', customerid, '@new.mail.com') else email end as email,
  phone, case when k % 7 = 0 then 'new harbor' else city end as city, '{SECOND_LOAD}' as loaded
from (select *, cast(customerid as bigint) as k from {{first}}) a
where k % 7 = 0 or k % 11 = 0 or k % 19 = 0
union all
select cast(k + 1 + (select max(cast(customerid as bigint)) from {{first}}) as string) as customerid,
  customername, email, phone, city, '{SECOND_LOAD}' as loaded
from (select *, cast(customerid as bigint) as k from {{first}}) b where k % 15 = 4""",
    "hotels": f"""
select hotelid, hotelname, city, stars,
  case when k % 3 = 0 then cast(k % 90 + 300 as string) else rooms end as rooms, '{SECOND_LOAD}' as loaded
from (select *, cast(hotelid as bigint) as k from {{first}}) a where k % 3 = 0 or k % 4 = 0
union all
select cast(k + 1 + (select max(cast(hotelid as bigint)) from {{first}}) as string) as hotelid,
  hotelname, city, stars, rooms, '{SECOND_LOAD}' as loaded
from (select *, cast(hotelid as bigint) as k from {{first}}) b where k % 10 = 0""",
    "staff": f"""
select staffid, case when k % 10 = 1 then '0' else hotelid end as hotelid, staffname, role,
  case when k % 9 = 0 then 'Late Shift!' else shift end as shift, '{SECOND_LOAD}' as loaded
from (select *, cast(staffid as bigint) as k from {{first}}) a where k % 9 = 0 or k % 10 = 1
union all
select cast(k + 1 + (select max(cast(staffid as bigint)) from {{first}}) as string) as staffid,
  hotelid, staffname, role, shift, '{SECOND_LOAD}' as loaded
from (select *, cast(staffid as bigint) as k from {{first}}) b where k % 16 = 5""",
    "reviews": f"""
select reviewid, bookingid, customerid, case when k % 40 = 0 then '4' else rating end as rating,
  case when k % 41 = 0 then 'second thoughts' else comments end as comments, sentiment,
  '{SECOND_LOAD}' as loaded
from (select *, cast(reviewid as bigint) as k from {{first}}) a where k % 40 = 0 or k % 41 = 0
union all
select cast(k + 1 + (select max(cast(reviewid as bigint)) from {{first}}) as string) as reviewid,
  bookingid, customerid, rating, comments, sentiment, '{SECOND_LOAD}' as loaded
from (select *, cast(reviewid as bigint) as k from {{first}}) b where k % 60 = 7""",
    "room_rates": f"""
select roomrateid, hotelid, roomtype, price, available,
  case when k % 6 = 0 then '99.90' else discountedprice end as discountedprice, '{SECOND_LOAD}' as loaded
from (select *, cast(roomrateid as bigint) as k from {{first}}) a where k % 6 = 0 or k % 37 = 0
union all
select cast(k + 1 + (select max(cast(roomrateid as bigint)) from {{first}}) as string) as roomrateid,
  hotelid, roomtype, price, available, discountedprice, '{SECOND_LOAD}' as loaded
from (select *, cast(roomrateid as bigint) as k from {{first}}) b where k % 25 = 3""",
}


def raw_select(feed: str, batch: int) -> str:
    """Rows of ``{delivery}`` as they lie in the raw table."""
    loaded = "loaded" if batch > 1 else f"'{FIRST_LOAD}'"
    return (
        f"select {', '.join(FEED_SCHEMAS[feed].fieldNames())}, "
        f"cast({loaded} as {{timestamp}}) as _loaded_at, "
        f"'{feed}/{batch}' as _filename, cast({batch} as bigint) as _batch_id from {{delivery}}"
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, text: str, **frames: DataFrame) -> DataFrame:
    """Run a shared text on Spark over the tables and frames it names."""
    named = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **named, **frames)


def delivery(spark: SparkSession, sf_dir: str, feed: str, batch: int, first: DataFrame | None = None) -> DataFrame:
    """Business columns of a delivery (and ``loaded`` for the second). ``first`` is the feed's first
    delivery if it is stored; the second one names it several times."""
    if batch == 1:
        return run_sql(spark, sf_dir, FIRST_DELIVERY[feed])
    if first is None:
        first = delivery(spark, sf_dir, feed, 1)
    return run_sql(spark, sf_dir, SECOND_DELIVERY[feed], first=first.select(*FEED_SCHEMAS[feed].fieldNames()))


def raw_batch(spark: SparkSession, sf_dir: str, feed: str, batch: int, first: DataFrame | None = None) -> DataFrame:
    text = raw_select(feed, batch).replace("{timestamp}", "timestamp_ntz")
    return spark.sql(text, delivery=delivery(spark, sf_dir, feed, batch, first))
