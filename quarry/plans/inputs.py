"""Inputs shaped like raw open data, derived from the given tables by SQL that Spark and DuckDB both take.

In the texts {orders} and so on stand for tables, {ntz} for the type of a time without zone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

RAW_ORDERS = """
select o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderstatus,
  case when o_orderkey % 97 = 0 then '-1' when o_orderkey % 89 = 0 then '0' when o_orderkey % 83 = 0 then '' when o_orderkey % 79 = 0 then 'x'
       else cast((o_custkey * 7919 + o_orderkey * 104729) % 700000 as string) end as easting_raw,
  case when o_orderkey % 101 = 0 then '-1' when o_orderkey % 73 = 0 then 'n/a'
       else cast((o_custkey * 104729 + o_orderkey * 7919) % 1300000 as string) end as northing_raw,
  case when o_orderkey % 71 = 0 then 'bad'
       else substr(cast(o_orderdate as string), 9, 2) || '/' || substr(cast(o_orderdate as string), 6, 2) || '/' || substr(cast(o_orderdate as string), 1, 4) end as date_raw,
  case when o_orderkey % 67 = 0 then '' else lpad(cast(o_orderkey % 24 as string), 2, '0') || ':' || lpad(cast((o_orderkey * 7) % 60 as string), 2, '0') end as time_raw,
  case when o_orderkey % 61 = 0 then '-1' when o_orderkey % 59 = 0 then 'x' else substr(o_orderpriority, 1, 1) end as prio_raw,
  case when o_orderkey % 53 = 0 then '' when o_orderkey % 47 = 0 then '-1' when o_orderkey % 43 = 0 then 'many' else cast(o_orderkey % 9 as string) end as number_raw
from {orders}"""

RAW_COUNTS = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, 1992 + cast(l_partkey % 7 as int) as year,
  'R' || cast(l_suppkey % 20 as string) as road_name,
  case when l_orderkey % 41 = 0 then '' else cast(l_partkey * 37 % 750000 as string) end as easting_raw,
  case when l_orderkey % 37 = 0 then 'y' else cast(l_suppkey * 6151 % 1350000 as string) end as northing_raw,
  case when l_orderkey % 31 = 0 then 'x' when l_orderkey % 29 = 0 then '-5' else cast(cast(l_quantity as int) * 100 as string) end as volume_raw,
  1 + l_tax * 10 as link_length_km
from {lineitem}"""

CODE = """case when {k} % 7 = 6 then 'X' when {k} % 4 = 0 then 'E' when {k} % 4 = 1 then 'S' when {k} % 4 = 2 then 'W' else 'N' end || '{v}' || lpad(cast({k} as string), 3, '0')"""


def code(k: str, v: int) -> str:
    return CODE.replace("{k}", k).replace("{v}", str(v))


AREAS = f"""
select n_nationkey as k, {code('n_nationkey', 0)} as area_code, cast('1990-01-01' as date) as valid_from, cast('1998-07-01' as date) as valid_to from {{nation}}
union all
select n_nationkey, {code('n_nationkey', 1)}, cast('1998-07-01' as date), cast(null as date) from {{nation}}"""

# Unit shapes: a square, an L, and a square with a hole; ring, order and vertex.
SHAPES = {
    0: [[(0, 0), (1, 0), (1, 1), (0, 1)]],
    1: [[(0, 0), (1, 0), (1, 0.5), (0.5, 0.5), (0.5, 1), (0, 1)]],
    2: [[(0, 0), (1, 0), (1, 1), (0, 1)], [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)]],
}
EDGES = ", ".join(
    f"({shape}, cast({a[0]} as double), cast({a[1]} as double), cast({b[0]} as double), cast({b[1]} as double))"
    for shape, rings in SHAPES.items()
    for ring in rings
    for a, b in zip(ring, ring[1:] + ring[:1])
)
AREA_EDGES = f"""
select a.area_code, a.valid_from, a.valid_to,
  (a.k % 5 + s.x1) * 140000 as x1, (floor(a.k / 5) + s.y1) * 260000 as y1, (a.k % 5 + s.x2) * 140000 as x2, (floor(a.k / 5) + s.y2) * 260000 as y2
from ({AREAS}) a join (values {EDGES}) as s(shape, x1, y1, x2, y2) on a.k % 3 = s.shape"""

PLACED_EVENTS = """
select event_id, user_id, ts, value, cast(50 + (user_id % 90) / 10.0 as double) as lat, cast(-6 + (user_id % 80) / 10.0 as double) as lon, event_id % 11 = 0 as time_imputed
from {events}"""

PLACED_ORDERS = """
select o_orderkey as event_id, o_custkey as user_id, cast(o_orderdate as {ntz}) + (interval '1' hour) * cast(o_orderkey % 24 as int) as ts, o_totalprice as value,
  cast(50 + (o_custkey % 90) / 10.0 as double) as lat, cast(-6 + (o_custkey % 80) / 10.0 as double) as lon, o_orderkey % 11 = 0 as time_imputed
from {orders}"""

EVENT_HOLIDAYS = """
select distinct case user_id % 3 when 0 then 'england-and-wales' when 1 then 'scotland' else 'northern-ireland' end as division, cast(ts as date) as holiday_date
from {events} where event_id % 97 = 0"""

GRID = """
select cast(50 + (user_id % 90) / 10.0 as double) as lat, cast(-6 + (user_id % 80) / 10.0 as double) as lon,
  cast(substr(cast(ts as string), 1, 13) || ':00:00' as {ntz}) as time_utc,
  case when event_id % 53 = 0 then cast('NaN' as double) when event_id % 59 = 0 then null else 270 + value end as t2m,
  case when event_id % 61 = 0 then null else value / 1000 end as tp
from {events} where user_id % 3 <> 0"""

HOLIDAYS = """
select division, cast(day as date) as holiday_date from (values
  ('england-and-wales', '1996-01-01'), ('england-and-wales', '1996-12-25'), ('england-and-wales', '1997-03-31'), ('england-and-wales', '1998-05-04'), ('england-and-wales', '2000-12-25'),
  ('scotland', '1996-01-02'), ('scotland', '1997-01-02'), ('scotland', '1999-01-04'), ('scotland', '2000-12-25'),
  ('northern-ireland', '1997-03-17'), ('northern-ireland', '1998-03-17'), ('northern-ireland', '1999-07-12')) as h(division, day)"""

CODEBOOK = """
select * from (values
  ('prio', '1', 'Urgent', false), ('prio', '2', 'High', false), ('prio', '3', 'Medium', false), ('prio', '4', 'Data missing or out of range', true), ('prio', '-1', 'Unknown', true),
  ('status', 'F', 'Filled', false), ('status', 'O', 'Open', false)) as c(variable, code, label, is_missing)"""

EDITIONS = """
select distinct 'customer-' || cast(o_custkey as string) as source_id, cast(o_orderdate as date) as valid_from from {orders}"""


def relation(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The derived input in Spark."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql.replace("{ntz}", "timestamp_ntz"), **used)


def duck(sql: str) -> str:
    """The same text for DuckDB."""
    return re.sub(r"\{(\w+)\}", lambda m: "timestamp" if m[1] == "ntz" else m[1], sql)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas with their edges as arrays."""
    edges = relation(spark, sf_dir, AREA_EDGES)
    return edges.groupBy("area_code", "valid_from", "valid_to").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
