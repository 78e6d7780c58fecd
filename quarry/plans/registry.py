"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import clean
from quarry.functions.civil_time import epoch_seconds, to_local, to_utc
from quarry.functions.clean import Field
from quarry.functions.geo import grid_to_degrees, grid_to_degrees_stages
from quarry.functions.solar import solar_position
from quarry.operators import audit, decode, spatial, stamps, vintages
from quarry.plans import contract, inputs
from quarry.plans.inputs import duck, relation
from quarry.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def with_(name_sql: dict[str, str], body: str) -> str:
    return "with " + ", ".join(f"{n} as ({duck(s)})" for n, s in name_sql.items()) + "\n" + body


RAW = {"raw": inputs.RAW_ORDERS}
COUNTS = {"raw": inputs.RAW_COUNTS}
POINT = """e as (select *, case when easting_raw in ('-1', '0', '') then null else try_cast(easting_raw as double) end easting,
  case when northing_raw in ('-1', '0', '') then null else try_cast(northing_raw as double) end northing from raw)"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, inputs.RAW_ORDERS)


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cleaned like events with a place, a time and a code."""
    return clean.settled(raw_orders(spark, sf_dir).withColumnRenamed("prio_raw", "prio").transform(_silver))


def _silver(raw: DataFrame) -> DataFrame:
    return raw.select(
        "o_orderkey",
        "o_custkey",
        "easting_raw",
        "northing_raw",
        "date_raw",
        "time_raw",
        *clean.sentinel_point("easting_raw", "northing_raw"),
        *clean.event_time("date_raw", "time_raw"),
        *clean.audited(raw, "prio", missing=["4"]),
    )


SILVER = f"""{POINT},
t as (select *, case when date_raw = 'bad' then null else strptime(date_raw, '%d/%m/%Y') end d from e),
silver as (select o_orderkey, o_custkey, easting_raw, northing_raw, date_raw, time_raw, easting, northing, easting is not null and northing is not null geom_valid,
  case when time_raw = '' then d else try_strptime(date_raw || ' ' || time_raw, '%d/%m/%Y %H:%M') end datetime_local, d is not null datetime_valid,
  d is not null and time_raw = '' time_imputed, prio_raw,
  case when prio_raw in ('-1', '4') then null else try_cast(prio_raw as integer) end prio,
  case when prio_raw in ('-1', '4') then null else try_cast(prio_raw as integer) end is not null prio_valid from t)"""


def silver_sql(body: str) -> str:
    return with_(RAW, f", {SILVER} {body}").replace("\n,", ",", 1)


# ---- cleaning -----------------------------------------------------------------------------------------------


@query(with_(RAW, """select o_orderkey, case when number_raw in ('-1', '') then null else try_cast(number_raw as integer) end number,
  case when easting_raw in ('-1', '') then null else try_cast(easting_raw as double) end easting, date_raw, cast(null as integer) absent from raw"""))
def clean_numeric_columns(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        "o_orderkey",
        clean.numeric("number_raw").alias("number"),
        clean.numeric("easting_raw", "double").alias("easting"),
        "date_raw",
        clean.placeholder("int").alias("absent"),
    )


@query(with_(RAW, """select o_orderkey, case when prio_raw in ('-1', '4') then null else try_cast(prio_raw as integer) end prio,
  case when number_raw in ('-1', '') then null else try_cast(number_raw as integer) end number, o_orderstatus status, cast(null as integer) weather from raw"""))
def clean_coded_columns(spark, sf_dir):
    raw = raw_orders(spark, sf_dir).withColumnsRenamed({"prio_raw": "prio", "number_raw": "number", "o_orderstatus": "status"})
    missing = clean.missing_codes(relation(spark, sf_dir, inputs.CODEBOOK))
    manifest = [Field("status", "text"), Field("prio", "coded"), Field("weather", "coded"), Field("number", "numeric", "int"), Field("date_raw", "text")]
    return raw.select("o_orderkey", *clean.broad(raw, manifest, missing, exclude=["date_raw"]))


@query("""select o_orderkey, coalesce(collision_reference, accident_reference) reference, coalesce(price, 0) price from (
  select o_orderkey, 'c' || o_orderkey collision_reference, null accident_reference, o_totalprice price from orders where year(o_orderdate) >= 1998
  union all select o_orderkey, null, 'a' || o_orderkey, null from orders where year(o_orderdate) < 1998)""")
def alias_coalesce_union(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    new = orders.filter(F.year("o_orderdate") >= 1998).select("o_orderkey", F.concat(F.lit("c"), "o_orderkey").alias("collision_reference"), F.col("o_totalprice").alias("price"))
    old = orders.filter(F.year("o_orderdate") < 1998).select("o_orderkey", F.concat(F.lit("a"), "o_orderkey").alias("accident_reference"))
    both = files.united([new, old])
    reference = clean.first_present(both, ["collision_reference", "accident_reference", "collision_ref_no"])
    return both.select("o_orderkey", reference.alias("reference"), F.coalesce("price", F.lit(0.0)).alias("price"))


@query(with_(RAW, """select o_orderkey, prio_raw, case when prio_raw in ('-1', '4') then null else try_cast(prio_raw as integer) end prio,
  prio_raw not in ('-1', '4') and try_cast(prio_raw as integer) is not null prio_valid, cast(null as varchar) light_raw, cast(null as integer) light, true light_valid from raw"""))
def audited_code_triple(spark, sf_dir):
    raw = raw_orders(spark, sf_dir).withColumnRenamed("prio_raw", "priority_old")
    return raw.select("o_orderkey", *clean.audited(raw, "prio", ["priority_old"], ["4"]), *clean.audited(raw, "light"))


@query(with_(RAW, f", {POINT} select o_orderkey, easting, northing, easting is not null and northing is not null geom_valid from e").replace("\n,", ","))
def sentinel_points(spark, sf_dir):
    return raw_orders(spark, sf_dir).select("o_orderkey", *clean.sentinel_point("easting_raw", "northing_raw"))


@query(with_(COUNTS, """select l_orderkey, l_linenumber, try_cast(easting_raw as integer) easting, try_cast(northing_raw as integer) northing,
  coalesce(try_cast(easting_raw as integer) between 0 and 700000 and try_cast(northing_raw as integer) between 0 and 1300000, false) geom_valid,
  volume_raw, try_cast(volume_raw as bigint) volume, coalesce(try_cast(volume_raw as bigint) >= 0, false) volume_valid from raw"""))
def envelope_points(spark, sf_dir):
    raw = relation(spark, sf_dir, inputs.RAW_COUNTS)
    return raw.select("l_orderkey", "l_linenumber", *clean.envelope_point("easting_raw", "northing_raw"), *clean.count_field("volume_raw", "volume"))


@query(silver_sql("select o_orderkey, datetime_local, datetime_valid, time_imputed from silver"))
def event_time_fallback(spark, sf_dir):
    return raw_orders(spark, sf_dir).select("o_orderkey", *clean.event_time("date_raw", "time_raw"))


@query("select l_orderkey || '|' || l_linenumber row_key, l_quantity from lineitem")
def row_keys(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(clean.row_key("l_orderkey", "l_linenumber").alias("row_key"), "l_quantity")


@query(silver_sql("select o_orderkey, easting, northing, datetime_local, prio from silver where geom_valid and datetime_valid and prio_valid"))
def gold_view(spark, sf_dir):
    return clean.gold(silver_orders(spark, sf_dir), ["geom_valid", "datetime_valid", "prio_valid"]).select("o_orderkey", "easting", "northing", "datetime_local", "prio")


@query("""select distinct lower(trim(p_brand)) variable, code, trim(p_type) label, code = '-1' or lower(trim(p_type)) in
  (""" + ", ".join(f"'{x}'" for x in decode.MISSING_LABELS) + """) is_missing
  from (select p_brand, p_type, case when p_size % 13 = 0 then '-1' when p_size % 11 = 0 then 'n' else cast(p_size as varchar) end code from part) where try_cast(code as integer) is not null""")
def codebook_from_codelist(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    size = F.when(F.col("p_size") % 13 == 0, "-1").when(F.col("p_size") % 11 == 0, "n").otherwise(F.col("p_size").cast("string"))
    return decode.derived_codebook(part.select(F.col("p_brand").alias("variable"), size.alias("code"), F.col("p_type").alias("label")))


# ---- audit --------------------------------------------------------------------------------------------------

RULES = (
    audit.Rule("coord", "geom_valid", "easting,northing", "concat_ws(',', coalesce(easting_raw, ''), coalesce(northing_raw, ''))", "no usable coordinate"),
    audit.Rule("datetime", "datetime_valid", "date", "date_raw", "no usable date"),
    audit.Rule("prio", "prio_valid", "prio", "prio_raw", "no usable code"),
    audit.Rule("time", "time_imputed", "time", "time_raw", "time imputed", warn=True),
)
SPEC = audit.SourceSpec(
    "orders", "o_orderkey", (audit.Dimension("geom_valid", ("coord",)), audit.Dimension("datetime_valid", ("datetime",), 0.02), audit.Dimension("prio_valid", ("prio",), 0.5))
)
LEDGER_SQL = """ledger as (
  select 'coord' rule_id, 'reject_dimension' severity, o_orderkey k, 'easting,northing' column_name, easting_raw || ',' || northing_raw raw_value from silver where not geom_valid
  union all select 'datetime', 'reject_dimension', o_orderkey, 'date', date_raw from silver where not datetime_valid
  union all select 'prio', 'reject_dimension', o_orderkey, 'prio', prio_raw from silver where not prio_valid
  union all select 'time', 'warn', o_orderkey, 'time', time_raw from silver where time_imputed)"""


@query(silver_sql(f", {LEDGER_SQL} select 'orders' source_id, k::varchar source_row_key, rule_id, severity, column_name, raw_value from ledger").replace("from t) ,", "from t),"))
def rejection_ledger(spark, sf_dir):
    silver = silver_orders(spark, sf_dir)
    return audit.ledger(silver, "orders", "o_orderkey", RULES).drop("rule_desc", "ingested_at")


@query(silver_sql(f", {LEDGER_SQL} select 'orders' source_id, rule_id, severity, count(*) n from ledger group by all").replace("from t) ,", "from t),"))
def ledger_by_rule(spark, sf_dir):
    entries = audit.ledger(silver_orders(spark, sf_dir), "orders", "o_orderkey", RULES)
    return entries.groupBy("source_id", "rule_id", "severity").agg(F.count("*").alias("n"))


@query("""select 'lineitem' source_id, n source_rows, n - q bronze_rows, n - q silver_rows, q quarantine_rows, true conserved, q / n quarantine_rate from (
  select (select count(*) from lineitem) n, (select count(*) from lineitem where l_orderkey % 401 = 0) q)""")
def conservation_report(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    good = lineitem.filter("l_orderkey % 401 <> 0")
    tables = audit.SourceTables(
        bronze=good,
        silver=good.select(clean.row_key("l_orderkey", "l_linenumber").alias("row_key")),
        ledger=good.limit(0),
        quarantine=lineitem.filter("l_orderkey % 401 = 0"),
        source_rows=lineitem.groupBy("l_returnflag").count().agg(F.sum("count").alias("source_rows")),
    )
    return audit.conservation(audit.SourceSpec("lineitem", "row_key"), tables)


@query(silver_sql("""select flag, case when flag = 'datetime_valid' then (select count(*) from silver where not datetime_valid and o_orderkey % 2 = 0) else 0 end n_flag_only,
  case when flag = 'prio_valid' then (select count(*) from silver where prio_valid and o_orderkey % 500 = 1) else 0 end n_ledger_only
  from (values ('geom_valid'), ('datetime_valid'), ('prio_valid')) f(flag)"""))
def flag_ledger_agreement(spark, sf_dir):
    silver = silver_orders(spark, sf_dir)
    entries = audit.ledger(silver, "orders", "o_orderkey", RULES)
    entries = entries.filter("not (rule_id = 'datetime' and cast(source_row_key as bigint) % 2 = 0)")  # lost
    extra = silver.filter("prio_valid and o_orderkey % 500 = 1").withColumn("prio_valid", F.lit(False))  # invented
    return audit.flag_ledger_agreement(SPEC, silver, entries.unionByName(audit.ledger(extra, "orders", "o_orderkey", RULES[2:3])))


@query(silver_sql("""select *, n_rejected / n_total rate, n_rejected / n_total <= ceiling as "within" from (
  select 'geom_valid' flag, count(*) n_total, count(*) filter (not geom_valid) n_rejected, 0.05::double ceiling from silver
  union all select 'datetime_valid', count(*), count(*) filter (not datetime_valid), 0.02 from silver
  union all select 'prio_valid', count(*), count(*) filter (not prio_valid), 0.5 from silver)"""))
def reject_rates(spark, sf_dir):
    return audit.reject_rates(SPEC, silver_orders(spark, sf_dir))


@query(silver_sql("select 'silver' tbl, col, n_total, n_present, n_total - n_present n_missing, n_present / n_total rate from (" + " union all ".join(
    f"select '{c}' col, count(*) n_total, count({c}) n_present from silver" for c in ("easting", "northing", "datetime_local", "prio")) + ")"))
def completeness_report(spark, sf_dir):
    return decode.completeness(silver_orders(spark, sf_dir), ["easting", "northing", "datetime_local", "prio"], "silver")


@query("""select distinct 'user-' || user_id source_id from events where user_id not in (select user_id from events where event_type = 'purchase' and value > 95)
  and user_id not in (select user_id from events where event_type = 'error' and value > 97 and event_id % 3 <> 0)""")
def audit_coverage(spark, sf_dir):
    """Every user is a source: audited after a large purchase, exempt after a bad error unless the reason is blank."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("source_id", F.concat(F.lit("user-"), "user_id"))
    specs = events.filter("event_type = 'purchase' and value > 95").select("source_id")
    reason = F.when(F.col("event_id") % 3 == 0, F.lit(" ")).otherwise(F.col("event_type"))
    excused = events.filter("event_type = 'error' and value > 97").select("source_id", reason.alias("reason"))
    return audit.undecided(events.select("source_id").distinct(), specs, excused)


# ---- joins --------------------------------------------------------------------------------------------------


@query("""select l_orderkey, l_linenumber, exists (select 1 from orders where o_orderkey = l_orderkey and o_orderkey % 17 <> 0) link_valid from lineitem""")
def referential_link(spark, sf_dir):
    line, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    return stamps.with_link(line.select("l_orderkey", "l_linenumber"), orders.filter("o_orderkey % 17 <> 0"), "l_orderkey", "o_orderkey")


@query("""select l_orderkey || '|' || l_linenumber source_row_key, l_orderkey::varchar raw_value from lineitem
  where l_orderkey not in (select o_orderkey from orders where o_orderkey % 17 <> 0)""")
def orphans(spark, sf_dir):
    line, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    lost = stamps.orphans(line, orders.filter("o_orderkey % 17 <> 0"), "l_orderkey", "o_orderkey")
    return lost.select(clean.row_key("l_orderkey", "l_linenumber").alias("source_row_key"), F.col("l_orderkey").cast("string").alias("raw_value"))


BOOK = {"book": inputs.CODEBOOK}


@query(with_(RAW | BOOK, """select o_orderkey, prio_raw prio, o_orderstatus status, p.label prio_label, s.label status_label from raw
  left join book p on p.variable = 'prio' and p.code = prio_raw left join book s on s.variable = 'status' and s.code = o_orderstatus"""))
def decode_labels(spark, sf_dir):
    coded = raw_orders(spark, sf_dir).select("o_orderkey", F.col("prio_raw").alias("prio"), F.col("o_orderstatus").alias("status"))
    return decode.labelled(coded, relation(spark, sf_dir, inputs.CODEBOOK), ["prio", "status"])


@query(with_(RAW | BOOK, """select 'prio' variable, count(*) filter (prio_raw not in (select code from book where variable = 'prio')) n_undecoded from raw
  union all select 'status', count(*) filter (o_orderstatus not in (select code from book where variable = 'status')) from raw"""))
def undecoded_codes(spark, sf_dir):
    coded = raw_orders(spark, sf_dir).select("o_orderkey", F.col("prio_raw").alias("prio"), F.col("o_orderstatus").alias("status"))
    return decode.undecoded(coded, relation(spark, sf_dir, inputs.CODEBOOK), ["prio", "status"])


EDITIONS = {"ed": inputs.EDITIONS}


@query(with_(EDITIONS, "select source_id, valid_from, lead(valid_from) over (partition by source_id order by valid_from) valid_to from ed"))
def vintage_windows(spark, sf_dir):
    return vintages.chained(relation(spark, sf_dir, inputs.EDITIONS)).select("source_id", "valid_from", "valid_to")


@query(with_(EDITIONS, """, w as (select source_id, valid_from, lead(valid_from) over (partition by source_id order by valid_from) valid_to from ed),
  m as (select *, valid_from <= date '1997-12-31' and (valid_to is null or valid_to > date '1996-01-01') ok, min(valid_from) over (partition by source_id) f from w),
  n as (select *, bool_or(ok) over (partition by source_id) any_ from m)
  select source_id, valid_from, valid_to from n where ok or (not any_ and valid_from = f)""").replace("\n,", ",", 1))
def vintage_selection(spark, sf_dir):
    windows = vintages.chained(relation(spark, sf_dir, inputs.EDITIONS))
    return vintages.selected(windows, "temporal", (1996, 1997)).select("source_id", "valid_from", "valid_to")


EDGES = {"edges": inputs.AREA_EDGES}


def located_sql(points: str, predicate: str) -> str:
    return f"""hit as (select o_orderkey, area_code from {points} p join edges g on {predicate} and (y1 > northing) != (y2 > northing)
    and easting < (x2 - x1) * (northing - y1) / (y2 - y1) + x1 group by o_orderkey, area_code having count(*) % 2 = 1),
  stamp as (select o_orderkey, min(area_code) lad_code from hit group by o_orderkey)"""


def points_of(spark, sf_dir):
    return silver_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "easting", "northing", "datetime_local")


@query(with_(RAW | EDGES, f", {SILVER}, {located_sql('silver', 'valid_to is null')} select o_orderkey, lad_code from silver left join stamp using (o_orderkey)").replace("\n,", ",", 1))
def point_in_polygon_snapshot(spark, sf_dir):
    stamped = spatial.with_area(points_of(spark, sf_dir), inputs.areas(spark, sf_dir), "o_orderkey", "lad_code")
    return stamped.select("o_orderkey", "lad_code")


DAY = "(valid_from <= datetime_local::date and (valid_to is null or datetime_local::date < valid_to))"
JULY = "(valid_from <= make_date(year(datetime_local), 7, 1) and (valid_to is null or make_date(year(datetime_local), 7, 1) < valid_to))"


@query(with_(RAW | EDGES, f", {SILVER}, {located_sql('silver', DAY)} select o_orderkey, lad_code from silver left join stamp using (o_orderkey)").replace("\n,", ",", 1))
def point_in_polygon_temporal(spark, sf_dir):
    day = F.col("datetime_local").cast("date")
    return spatial.with_area(points_of(spark, sf_dir), inputs.areas(spark, sf_dir), "o_orderkey", "lad_code", "temporal", day).select("o_orderkey", "lad_code")


@query(with_(RAW | EDGES, f", {SILVER}, {located_sql('silver', JULY)} select o_orderkey, lad_code from silver left join stamp using (o_orderkey)").replace("\n,", ",", 1))
def point_in_polygon_midyear(spark, sf_dir):
    day = vintages.mid_year(F.year("datetime_local"))
    return spatial.with_area(points_of(spark, sf_dir), inputs.areas(spark, sf_dir), "o_orderkey", "lad_code", "temporal", day).select("o_orderkey", "lad_code")


QUAD = "cast(k % 89 as double) x1, cast(k * 31 % 97 as double) y1, cast(k * 17 % 83 as double) x2, cast(k * 7 % 79 as double) y2, cast(k * 13 % 73 as double) x3, cast(k * 29 % 71 as double) y3, cast(k * 11 % 67 as double) x4, cast(k * 19 % 61 as double) y4"


def validity_sql(rings: str, name: str) -> str:
    """Faults by brute force over pairs of sides; `rings` gives k, p, r and pts, a list of {x, y}. Crossings are found by where along both sides they lie, not by turns."""
    at = "((x1 - ax1) * {v}y - (y1 - ay1) * {v}x) / nullif(d, 0)"
    along = {"t": at.format(v="q"), "u": at.format(v="w")}
    return f"""with ring as ({rings}),
  clean as (select k, p, r, list_filter(pts, lambda q, i: i = 1 or q <> pts[i - 1]) c, pts[1] = pts[-1] closed from ring),
  good as (select *, len(c) >= 4 and closed fine from clean),
  side as materialized (select k, p, r, len(c) - 1 m, unnest(range(1, len(c))) i, c[i].x x1, c[i].y y1, c[i + 1].x x2, c[i + 1].y y2 from good where fine),
  pair as (select a.k, a.p = b.p and a.r = b.r same, abs(a.i - b.i) in (1, a.m - 1) nb, a.x1 ax1, a.y1 ay1, a.x2 ax2, a.y2 ay2, b.x1, b.y1, b.x2, b.y2, a.x2 - a.x1 wx, a.y2 - a.y1 wy, b.x2 - b.x1 qx, b.y2 - b.y1 qy,
    (a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1) d from side a join side b on a.k = b.k and (a.p, a.r, a.i) < (b.p, b.r, b.i)
    and least(a.x1, a.x2) <= greatest(b.x1, b.x2) and least(b.x1, b.x2) <= greatest(a.x1, a.x2) and least(a.y1, a.y2) <= greatest(b.y1, b.y2) and least(b.y1, b.y2) <= greatest(a.y1, a.y2)),
  met as (select *, d = 0 and (x1 - ax1) * wy = (y1 - ay1) * wx inline, {along['t']} t, {along['u']} u from pair),
  kind as (select k, case when t > 1e-12 and t < 1 - 1e-12 and u > 1e-12 and u < 1 - 1e-12 then 'crossing'
    when inline and (least(greatest(ax1, ax2), greatest(x1, x2)) > greatest(least(ax1, ax2), least(x1, x2)) or least(greatest(ay1, ay2), greatest(y1, y2)) > greatest(least(ay1, ay2), least(y1, y2))) then 'overlap'
    when same and not nb and (inline or (t between -1e-12 and 1 + 1e-12 and u between -1e-12 and 1 + 1e-12)) then 'self-touch' end fault from met),
  crossed as materialized (select distinct k, fault from kind where fault is not null),
  within as (select v.k, v.p, v.r, s.p q, s.r o, count(*) filter ((s.y1 > v.y1) <> (s.y2 > v.y1) and v.x1 < (s.x2 - s.x1) * (v.y1 - s.y1) / nullif(s.y2 - s.y1, 0) + s.x1) % 2 = 1 inner_
    from side v join side s on v.k = s.k and (v.p <> s.p or v.r <> s.r) where v.i = 1 and v.k not in (select k from crossed) group by all),
  judged as (select k, p, r, q, coalesce(bool_or(o = 0 and inner_), false) shell, coalesce(bool_or(o > 0 and inner_), false) hole from within group by all),
  fault as (select k, case when r > 0 and q = p and hole then 'nested holes' when r > 0 and q = p and not shell then 'hole outside' when r = 0 and q <> p and shell and not hole then 'nested shells' end f from judged
    union all select k, fault from crossed union all select k, 'ring' from good where not fine)
  select k {name}, count(distinct f) = 0 geom_valid, coalesce(string_agg(distinct f, ',' order by f), '') faults from (select distinct k from ring) left join fault using (k) group by k"""


@query(validity_sql(f"select k, 0 p, 0 r, case when k % 7 = 0 then pts else pts || pts[1:1] end pts from (select k, [{{'x': x1, 'y': y1}}, {{'x': x2, 'y': y2}}, {{'x': x3, 'y': y3}}, {{'x': x4, 'y': y4}}] pts from (select k, {QUAD} from (select distinct o_orderkey k from orders)))", "o_orderkey"))
def boundary_validity(spark, sf_dir):
    """Four-sided rings from the keys of orders: every seventh is open, many cross or touch themselves."""
    quads = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k")).distinct().selectExpr("k", *QUAD.split(", "))
    p = lambda i: F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y"))
    corners = F.array(p(1), p(2), p(3), p(4))
    ring = F.when(F.col("k") % 7 == 0, corners).otherwise(F.concat(corners, F.array(p(1))))
    shapes_ = quads.select(F.col("k").alias("o_orderkey"), F.array(F.array(ring)).alias("polygons"))
    return spatial.boundary_validity(shapes_, "o_orderkey").select("o_orderkey", "geom_valid", F.array_join("geom_faults", ",").alias("faults"))


# Rings about a middle, by polygon and ring: first component, corners, radius, middle; components move the corners in and out, and the middle.
AROUND = ((0, 0, 1, 16, 100, 0), (0, 1, 17, 8, 30, 40), (0, 2, 25, 8, 20, -40), (1, 0, 33, 12, 40, 150), (2, 0, 45, 16, 25, -40))


def around(start: int, n: int, radius: int, middle: int) -> list[tuple[str, str]]:
    """SQL of the corners: directions are rounded so that both engines reckon with the same numbers."""
    e = lambda k: f"cast(embedding[{k}] as double)"
    at = []
    for j in range(n):
        turn = 2 * math.pi * j / n
        far = f"({radius} * (1 + {e(start + j)}))"
        at.append((f"{middle} + 60 * {e(start)} + {far} * {round(math.cos(turn), 4)!r}", f"40 * {e(start + 1)} + {far} * {round(math.sin(turn), 4)!r}"))
    return [*at, at[0]]


def around_sql(p: int, r: int, *ring: int) -> str:
    return f"select vec_id k, {p} p, {r} r, [{', '.join(f'{{x: {x}, y: {y}}}' for x, y in around(*ring))}] pts from embeddings where len(embedding) >= 60"


@query(validity_sql(" union all ".join(around_sql(*ring) for ring in AROUND), "vec_id"))
def shapes_of_vectors(spark, sf_dir):
    """Three polygons, one with two holes, around which the components of a vector shift corners and middles; some cross, lie outside or within each other."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter("size(embedding) >= 60")
    point = lambda x, y: F.struct(F.expr(zero_based(x)).alias("x"), F.expr(zero_based(y)).alias("y"))
    rings = {(p, r): F.array(*(point(x, y) for x, y in around(*ring))) for p, r, *ring in AROUND}
    polygons = [F.array(*(ring for (p, _), ring in rings.items() if p == k)) for k in sorted({p for p, _ in rings})]
    judged = spatial.boundary_validity(vectors.select("vec_id", F.array(*polygons).alias("polygons")), "vec_id")
    return judged.select("vec_id", "geom_valid", F.array_join("geom_faults", ",").alias("faults"))


def zero_based(sql: str) -> str:
    return re.sub(r"embedding\[(\d+)\]", lambda m: f"embedding[{int(m[1]) - 1}]", sql)


@query("""select 'A' || o_orderkey area_code, 'area ' || o_custkey area_name, '2024' vintage, case when o_orderkey % 2 = 1 then 2 else 1 end n_polygons,
  case when o_orderkey % 2 = 1 then 8 else 4 end n_points, case when o_orderkey % 2 = 1 then 2 else 1 end * (4.0 * (o_custkey % 1000) + 2.5)::double x_sum from orders""")
def geojson_areas(spark, sf_dir):
    """Features read from GeoJSON text, a polygon or two each."""
    x = F.col("o_custkey") % 1000
    ring = F.format_string("[[[%d,1],[%d.5,1],[%d,2.25],[%d,1]]]", x, x + 2, x, x)
    many = F.col("o_orderkey") % 2 == 1
    shape = F.when(many, F.format_string('"MultiPolygon","coordinates":[%s,%s]', ring, ring)).otherwise(F.format_string('"Polygon","coordinates":%s', ring))
    text = F.format_string(
        '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"CD":"A%d","NM":"area %d"},"geometry":{"type":%s}}]}', "o_orderkey", "o_custkey", shape
    )
    rows = files.geojson_rows(spark.read.parquet(f"{sf_dir}/orders.parquet").select(text.alias("value")), "CD", "NM", "2024")
    points = F.flatten(F.flatten("polygons"))
    total = F.aggregate(points, F.lit(0.0), lambda n, q: n + q["x"])
    return rows.select("area_code", "area_name", "vintage", F.size("polygons").alias("n_polygons"), F.size(points).alias("n_points"), total.alias("x_sum"))


def stages_sql(start: str, stages: list[dict[str, str]]) -> str:
    out, at = [], start
    for k, stage in enumerate(stages):
        out.append(f"st{k} as (select *, {', '.join(f'{e} as {n}' for n, e in stage.items())} from {at})")
        at = f"st{k}"
    return ", ".join(out)


GEO = grid_to_degrees_stages("easting", "northing")


@query(with_(RAW, f", {POINT}, {stages_sql('e', GEO)} select o_orderkey, round(lon, 6) lon, round(lat, 6) lat from st{len(GEO) - 1}").replace("\n,", ",", 1))
def reproject_points(spark, sf_dir):
    points = raw_orders(spark, sf_dir).select("o_orderkey", *clean.sentinel_point("easting_raw", "northing_raw"))
    return grid_to_degrees(points).select("o_orderkey", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


LONDON = "(({}) at time zone 'UTC') at time zone 'Europe/London'"


@query(with_({"grid": inputs.GRID, "ev": inputs.PLACED_EVENTS}, f""", cells as (select round(lat * 10)::int a, round(lon * 10)::int b, date_trunc('hour', {LONDON.format('time_utc')}) h,
    min(case when t2m is null or isnan(t2m) then null else t2m - 273.15 end) t, min(tp * 1000) p from grid group by all)
  select event_id, round(t, 4) temperature_c, round(p, 4) precipitation_mm from ev left join cells
  on a = round(lat * 10)::int and b = round(lon * 10)::int and h = date_trunc('hour', {LONDON.format('ts')}) and not time_imputed""").replace("\n,", ",", 1))
def grid_hour_stamp(spark, sf_dir):
    grid = relation(spark, sf_dir, inputs.GRID).select(
        clean.grid_index("lat").alias("lat_idx"),
        clean.grid_index("lon").alias("lon_idx"),
        to_local("time_utc").alias("datetime_local"),
        clean.measured("t2m", offset=-273.15).alias("temperature_c"),
        clean.measured("tp", scale=1000.0).alias("precipitation_mm"),
    )
    events = relation(spark, sf_dir, inputs.PLACED_EVENTS).withColumn("datetime_local", to_local("ts"))
    stamped = stamps.with_weather(events, grid, ["temperature_c", "precipitation_mm"])
    return stamped.select("event_id", F.round("temperature_c", 4).alias("temperature_c"), F.round("precipitation_mm", 4).alias("precipitation_mm"))


@query("""select vec_id, i // 8 as hour, (i % 8) // 4 as y, i % 4 as x, round(v, 5) v from (
  select vec_id, unnest(range(0, len(embedding) // 8 * 8)) i, unnest(embedding[:len(embedding) // 8 * 8])::double v from embeddings)""")
def cube_to_long(spark, sf_dir):
    """Vectors read as cubes of hours, two rows and four columns."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    hours = F.floor(F.size("embedding") / 8).cast("int")
    cubes = vectors.select(
        "vec_id",
        F.sequence(F.lit(0), hours - 1).alias("times"),
        F.array(F.lit(0), F.lit(1)).alias("lats"),
        F.array(*(F.lit(k) for k in range(4))).alias("lons"),
        F.slice("embedding", F.lit(1), hours * 8).alias("v"),
        F.transform(F.slice("embedding", F.lit(1), hours * 8), lambda _: F.col("vec_id")).alias("id"),
    )
    rows = files.cube_rows(cubes, ["v", "id"])
    v = F.col("v").cast("double")
    rounded = F.when((F.round(v, 5) == 0) & (v < 0), F.lit(-0.0)).otherwise(F.round(v, 5))  # zero keeps its sign, as in the SQL
    return rows.select(F.col("id").alias("vec_id"), F.col("time_utc").alias("hour"), F.col("lat").alias("y"), F.col("lon").alias("x"), rounded.alias("v"))


@query("""select 'd' || o_custkey % 5 division, o_orderkey || '-' || i title, (o_orderdate + to_days(i - 1))::date holiday_date, case when i = 2 then 'moved' else '' end notes,
  case when i = 1 then true end bunting from orders, (values (1), (2)) v(i)""")
def json_flatten(spark, sf_dir):
    """Calendars of two days each, nested as JSON text."""
    day = F.to_date("o_orderdate")
    text = F.format_string(
        '{"d%d": {"division": "d%d", "events": [{"title": "%d-1", "date": "%s", "bunting": true}, {"title": "%d-2", "date": "%s", "notes": "moved"}]}}',
        F.col("o_custkey") % 5, F.col("o_custkey") % 5, "o_orderkey", day.cast("string"), "o_orderkey", F.date_add(day, 1).cast("string"),
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(text.alias("j"))
    return files.calendar_days(files.holidays(orders, "j")).select("division", "title", "holiday_date", "notes", "bunting")


AREA_OF = f"case when o_orderkey % 23 = 0 then null else {inputs.code('c_nationkey', 1)} end"


@query(with_({"hol": inputs.HOLIDAYS}, f""", o as (select o_orderkey, case when o_orderkey % 71 = 0 then null else o_orderdate::date end d, {AREA_OF} lad_code from orders join customer on o_custkey = c_custkey),
  z as (select *, case when lad_code[1] in ('E', 'W') then 'england-and-wales' when lad_code[1] = 'S' then 'scotland' when lad_code[1] = 'N' then 'northern-ireland' end dv from o),
  c as (select division, min(year(holiday_date)) a, max(year(holiday_date)) b from hol group by division)
  select o_orderkey, lad_code, case when year(d) between a and b then exists (select 1 from hol h where h.division = dv and h.holiday_date = d) end is_bank_holiday
  from z left join c on dv = division""").replace("\n,", ",", 1))
def calendar_tristate(spark, sf_dir):
    orders = relation(spark, sf_dir, f"select o_orderkey, case when o_orderkey % 71 = 0 then null else o_orderdate end as day, {AREA_OF} as lad_code from {{orders}} join {{customer}} on o_custkey = c_custkey")
    return stamps.with_holiday(orders, relation(spark, sf_dir, inputs.HOLIDAYS), "lad_code", "day").select("o_orderkey", "lad_code", "is_bank_holiday")


@query("""select o_orderkey, case when o_orderkey % 5 = 0 then o_totalprice * 2 else o_totalprice end price from orders""")
def update_from_match(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_totalprice").alias("price"))
    match = orders.filter("o_orderkey % 5 = 0").select("o_orderkey", (F.col("price") * 2).alias("price"))
    return stamps.overwritten(orders, match, "o_orderkey", "price").select("o_orderkey", "price")


# The SQL takes the sun's direction as a vector, written by hand: it shares no text with the expressions it checks.
SUN_SQL = """sun1 as (select *, radians(lat) la, case when not time_imputed then floor(epoch(ts)) end s from ev),
  sun2 as (select *, (s / 86400 - 10957.5) / 36525 t, (s % 86400) / 240 turn from sun1),
  sun3 as (select *, radians(280.46646 + 36000.76983 * t + 0.0003032 * t * t) l, radians(357.52911 + 35999.05029 * t - 0.0001537 * t * t) m,
    0.016708634 - 0.000042037 * t - 0.0000001267 * t * t e, radians(125.04 - 1934.136 * t) om, (84381.448 - 46.815 * t - 0.00059 * t * t + 0.001813 * t * t * t) / 3600 tilt from sun2),
  sun4 as (select *, radians(tilt + 0.00256 * cos(om)) ob,
    l + radians((1.914602 - 0.004817 * t - 0.000014 * t * t) * sin(m) + (0.019993 - 0.000101 * t) * sin(2 * m) + 0.000289 * sin(3 * m) - 0.00569 - 0.00478 * sin(om)) lam from sun3),
  sun5 as (select *, sin(ob) * sin(lam) sd, tan(ob / 2) * tan(ob / 2) y from sun4),
  sun6 as (select *, sqrt(1 - sd * sd) cd, radians(turn + lon - 180) + y * sin(2 * l) - 2 * e * sin(m) + 4 * e * y * sin(m) * cos(2 * l) - y * y / 2 * sin(4 * l) - 1.25 * e * e * sin(2 * m) h from sun5),
  sun7 as (select *, degrees(asin(sin(la) * sd + cos(la) * cd * cos(h))) up, (degrees(atan2(-cd * sin(h), cos(la) * sd - sin(la) * cd * cos(h))) + 360) % 360 solar_azimuth from sun6),
  sun as (select event_id, user_id, ts, lat, lon, value, time_imputed, solar_azimuth, up + case when up > 85 then 0 when up > 5 then 58.1 / tan(radians(up)) - 0.07 / tan(radians(up)) ** 3 + 0.000086 / tan(radians(up)) ** 5
    when up > -0.575 then 1735 - 518.2 * up + 103.4 * up ** 2 - 12.79 * up ** 3 + 0.711 * up ** 4 else -20.772 / tan(radians(up)) end / 3600 solar_elevation from sun7)"""


def sun(spark, sf_dir, placed=inputs.PLACED_EVENTS):
    events = relation(spark, sf_dir, placed)
    seconds = F.when(~F.col("time_imputed"), epoch_seconds(F.col("ts")).cast("double"))
    return solar_position(events.withColumn("epoch_s", seconds))


def sun_sql(body: str, placed: str = inputs.PLACED_EVENTS) -> str:
    return with_({"ev": placed}, f", {SUN_SQL} {body}").replace("\n,", ",", 1)


@query(sun_sql("select event_id, round(solar_elevation, 4) elevation, round(solar_azimuth, 3) azimuth from sun"))
def solar_position_of_events(spark, sf_dir):
    return sun(spark, sf_dir).select("event_id", F.round("solar_elevation", 4).alias("elevation"), F.round("solar_azimuth", 3).alias("azimuth"))


@query(with_({"ev": inputs.PLACED_EVENTS}, """select event_id, ts + interval 270 day local_time, ((ts + interval 270 day) at time zone 'Europe/London') at time zone 'UTC' utc_time,
  ((ts + interval 180 day) at time zone 'UTC') at time zone 'Europe/London' summer_time from ev"""))
def civil_time(spark, sf_dir):
    events = relation(spark, sf_dir, inputs.PLACED_EVENTS)
    local = F.col("ts") + F.expr("interval 270 days")
    return events.select("event_id", local.alias("local_time"), to_utc(local).alias("utc_time"), to_local(F.col("ts") + F.expr("interval 180 days")).alias("summer_time"))


# ---- published analyses ---------------------------------------------------------------------------------------


@query(with_(RAW | EDGES | {"counts": inputs.RAW_COUNTS}, f""", {SILVER}, {located_sql('silver', 'valid_to is null')},
  crashes as (select 'R' || (o_custkey % 22) road_name, lad_code, count(*) n_events from silver join stamp using (o_orderkey) where prio_valid group by all),
  traffic as (select road_name, {inputs.code('(l_partkey % 25)', 1)} lad_code, sum(try_cast(volume_raw as bigint) * link_length_km) daily_vkm, count(distinct l_partkey) n_points
    from counts where year = 1997 and coalesce(try_cast(volume_raw as bigint) >= 0, false) group by all)
  select road_name, lad_code, n_events, round(daily_vkm, 2) daily_vkm, n_points, round(n_events / nullif(daily_vkm * 365 / 1e6, 0), 4) rate
  from traffic join crashes using (road_name, lad_code)""").replace("\n,", ",", 1))
def exposure_rate(spark, sf_dir):
    """Events per million vehicle-kilometres by road and area."""
    events = clean.gold(silver_orders(spark, sf_dir), ["prio_valid"]).select("o_orderkey", "o_custkey", "easting", "northing")
    placed = spatial.with_area(events, inputs.areas(spark, sf_dir), "o_orderkey", "lad_code").filter("lad_code is not null")
    crashes = placed.groupBy(F.concat(F.lit("R"), F.col("o_custkey") % 22).alias("road_name"), "lad_code").agg(F.count("*").alias("n_events"))
    counts = relation(spark, sf_dir, inputs.RAW_COUNTS).filter("year = 1997")
    area = F.expr(inputs.code("(l_partkey % 25)", 1))
    counts = counts.select("road_name", area.alias("lad_code"), "l_partkey", "link_length_km", *clean.count_field("volume_raw", "volume"))
    traffic = clean.gold(counts, ["volume_valid"]).groupBy("road_name", "lad_code").agg(F.sum(F.col("volume") * F.col("link_length_km")).alias("daily_vkm"), F.countDistinct("l_partkey").alias("n_points"))
    rate = F.try_divide(F.col("n_events").cast("double"), F.col("daily_vkm") * 365 / 1e6)
    both = traffic.join(crashes, ["road_name", "lad_code"])
    return both.select("road_name", "lad_code", "n_events", F.round("daily_vkm", 2).alias("daily_vkm"), "n_points", F.round(rate, 4).alias("rate")).orderBy(F.desc("rate"), "road_name", "lad_code")


@query(sun_sql(""", v as (select *, 1 + user_id % 8 code from sun), d as (select s.event_id, o.event_id other_id, round(180 - abs(abs(s.solar_azimuth - (o.code * 45) % 360) - 180), 3) off_axis,
  round(s.solar_elevation, 3) elevation from sun s join v o on s.user_id = o.user_id and s.event_id <> o.event_id where s.solar_elevation between 0 and 10)
  select * from d where off_axis <= 30 order by off_axis, event_id, other_id limit 200"""))
def glare_pairs(spark, sf_dir):
    """Low sun within 30 degrees of another event's heading; the 200 closest of all."""
    return glare_pairs_of_all_events(spark, sf_dir)


@query(sun_sql(""", v as (select *, 1 + user_id % 8 code from sun), d as (select s.event_id, o.event_id other_id, round(180 - abs(abs(s.solar_azimuth - (o.code * 45) % 360) - 180), 3) off_axis,
  round(s.solar_elevation, 3) elevation from sun s join v o on s.user_id = o.user_id and s.event_id <> o.event_id where s.solar_elevation between 0 and 10)
  select * from d where off_axis <= 30 order by off_axis, event_id, other_id limit 200"""))
def glare_pairs_of_all_events(spark, sf_dir):
    """Low sun within 30 degrees of another event's heading, over the headings of all events; the 200 closest.

    A heading is that of the user, so the 200 closest pairs are among those of the 200 closest events that have
    another event of their user; only these are joined.
    """
    low = sun(spark, sf_dir).filter(F.col("solar_elevation").between(0, 10)).select("event_id", "user_id", "solar_azimuth", "solar_elevation")
    events = relation(spark, sf_dir, inputs.PLACED_EVENTS).select(F.col("event_id").alias("other_id"), "user_id")
    several = events.groupBy("user_id").agg(F.min("other_id").alias("a"), F.max("other_id").alias("b")).filter("a < b").select("user_id")
    off = F.round(clean.angle_between(F.col("solar_azimuth"), clean.bearing(1 + F.col("user_id") % 8)), 3)
    closest = low.withColumn("off_axis", off).filter("off_axis <= 30").join(several, "user_id").orderBy("off_axis", "event_id").limit(200)
    pairs = closest.join(events, "user_id").filter("event_id <> other_id")
    return pairs.select("event_id", "other_id", "off_axis", F.round("solar_elevation", 3).alias("elevation")).orderBy("off_axis", "event_id", "other_id").limit(200)


@query(sun_sql(""", d as (select l_orderkey, l_linenumber, l_suppkey % 9 direction, round(180 - abs(abs(solar_azimuth - l_suppkey % 9 * 45 % 360) - 180), 3) off_axis, round(solar_elevation, 3) elevation
  from sun join lineitem on l_orderkey = event_id where solar_elevation between 0 and 10 and l_suppkey % 9 > 0) select * from d where off_axis <= 30""", inputs.PLACED_ORDERS))
def glare_of_vehicles(spark, sf_dir):
    """Every line of an order under a low sun that heads within 30 degrees of it; direction 0 is parked."""
    low = sun(spark, sf_dir, inputs.PLACED_ORDERS).filter(F.col("solar_elevation").between(0, 10)).select("event_id", "solar_azimuth", "solar_elevation")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 9).alias("direction")).filter("direction > 0")
    off = F.round(clean.angle_between(F.col("solar_azimuth"), clean.bearing("direction")), 3)
    both = lines.join(low, F.col("l_orderkey") == F.col("event_id"))
    return both.select("l_orderkey", "l_linenumber", "direction", off.alias("off_axis"), F.round("solar_elevation", 3).alias("elevation")).filter("off_axis <= 30")


@query(sun_sql("select count(*) n from sun where solar_elevation between 0 and 10 and solar_azimuth between 60 and 120"))
def low_sun_count(spark, sf_dir):
    return sun(spark, sf_dir).filter(F.col("solar_elevation").between(0, 10) & F.col("solar_azimuth").between(60, 120)).agg(F.count("*").alias("n"))


@query(sun_sql("""select count(*) n, round(sum(solar_elevation), 3) elevation_sum, round(sum(solar_azimuth), 2) azimuth_sum from sun
  where event_id % 5 = 0 and solar_elevation between 0 and 15 and solar_azimuth between 45 and 135"""))
def low_eastern_sun_clear(spark, sf_dir):
    """Events under a low sun in the east in clear weather: code 1 of five that the events carry."""
    clear = sun(spark, sf_dir).filter(1 + F.col("event_id") % 5 == 1)
    low = clear.filter(F.col("solar_elevation").between(0, 15) & F.col("solar_azimuth").between(45, 135))
    return low.agg(
        F.count("*").alias("n"),
        F.round(F.sum("solar_elevation"), 3).alias("elevation_sum"),
        F.round(F.sum("solar_azimuth"), 2).alias("azimuth_sum"),
    )


@query(with_(RAW | EDGES | {"hol": inputs.HOLIDAYS}, f""", {SILVER}, {located_sql('silver', 'valid_to is null')},
  one as (select * from silver join stamp using (o_orderkey) where geom_valid and datetime_valid and prio_valid order by datetime_local, o_orderkey limit 1),
  cv as (select division, min(year(holiday_date)) a, max(year(holiday_date)) b from hol group by division),
  z as (select *, case when lad_code[1] in ('E', 'W') then 'england-and-wales' when lad_code[1] = 'S' then 'scotland' when lad_code[1] = 'N' then 'northern-ireland' end dv from one)
  select o_orderkey, datetime_local, prio, lad_code, case when year(datetime_local) between a and b then exists (select 1 from hol h where h.division = dv and h.holiday_date = datetime_local::date) end is_bank_holiday
  from z left join cv on dv = division""").replace("\n,", ",", 1))
def unified_record(spark, sf_dir):
    """The earliest valid event that lies in an area, with all its stamps."""
    good = clean.gold(silver_orders(spark, sf_dir), ["geom_valid", "datetime_valid", "prio_valid"])
    stamped = spatial.with_area(good, inputs.areas(spark, sf_dir), "o_orderkey", "lad_code").filter("lad_code is not null")
    first = stamped.orderBy("datetime_local", "o_orderkey").limit(1)
    return stamps.with_holiday(first, relation(spark, sf_dir, inputs.HOLIDAYS), "lad_code", "datetime_local").select("o_orderkey", "datetime_local", "prio", "lad_code", "is_bank_holiday")


SPOT = "cast((user_id % 80) * 8750 + 100 as double) as easting, cast((user_id % 90) * 14440 + 70 as double) as northing"


@query(with_({"ev": inputs.PLACED_EVENTS, "grid": inputs.GRID, "hol": inputs.EVENT_HOLIDAYS} | EDGES, f""", {SUN_SQL}, spot as (select *, {LONDON.format('ts')} local_ts, {SPOT} from sun),
  hit as (select event_id, area_code from spot join edges on valid_to is null and (y1 > northing) != (y2 > northing) and easting < (x2 - x1) * (northing - y1) / (y2 - y1) + x1 group by all having count(*) % 2 = 1),
  area as (select event_id, min(area_code) lad_code from hit group by 1),
  cells as (select round(lat * 10)::int ca, round(lon * 10)::int cb, date_trunc('hour', {LONDON.format('time_utc')}) ch, min(case when t2m is null or isnan(t2m) then null else t2m - 273.15 end) ct, min(tp * 1000) cp from grid group by all),
  z as (select *, case when lad_code[1] in ('E', 'W') then 'england-and-wales' when lad_code[1] = 'S' then 'scotland' when lad_code[1] = 'N' then 'northern-ireland' end dv from spot left join area using (event_id)),
  cv as (select division, min(year(holiday_date)) y1, max(year(holiday_date)) y2 from hol group by division)
  select event_id, local_ts datetime_local, lad_code, round(ct, 4) temperature_c, round(cp, 4) precipitation_mm, round(solar_elevation, 4) elevation, round(solar_azimuth, 3) azimuth,
    case when year(local_ts) between y1 and y2 then exists (select 1 from hol where hol.division = dv and holiday_date = local_ts::date) end is_bank_holiday
  from z left join cells on ca = round(lat * 10)::int and cb = round(lon * 10)::int and ch = date_trunc('hour', local_ts) and not time_imputed left join cv on cv.division = dv""").replace("\n,", ",", 1))
def unified_records(spark, sf_dir):
    """Every event with all its stamps: area, weather, sun and calendar."""
    grid = relation(spark, sf_dir, inputs.GRID).select(
        clean.grid_index("lat").alias("lat_idx"),
        clean.grid_index("lon").alias("lon_idx"),
        to_local("time_utc").alias("datetime_local"),
        clean.measured("t2m", offset=-273.15).alias("temperature_c"),
        clean.measured("tp", scale=1000.0).alias("precipitation_mm"),
    )
    events = sun(spark, sf_dir).selectExpr("*", *SPOT.split(", ")).withColumn("datetime_local", to_local("ts"))
    placed = spatial.with_area(events, inputs.areas(spark, sf_dir), "event_id", "lad_code")
    stamped = stamps.with_weather(placed, grid, ["temperature_c", "precipitation_mm"])
    known = stamps.with_holiday(stamped, relation(spark, sf_dir, inputs.EVENT_HOLIDAYS), "lad_code", "datetime_local")
    rounded = [F.round(c, n).alias(a) for c, n, a in (("temperature_c", 4, "temperature_c"), ("precipitation_mm", 4, "precipitation_mm"), ("solar_elevation", 4, "elevation"), ("solar_azimuth", 3, "azimuth"))]
    return known.select("event_id", "datetime_local", "lad_code", *rounded, "is_bank_holiday")


LINE = "case when o_orderkey % 103 = 0 then cast(o_orderkey as string) || ',' || o_orderstatus when o_orderkey % 107 = 0 then cast(o_orderkey as string) || ',a,b,c' else cast(o_orderkey as string) || ',' || o_orderstatus || ',' || o_orderpriority end"


@query(f"""with l as (select {LINE} line from orders), n as (select line, len(line) - len(replace(line, ',', '')) c from l)
  select line, c = 2 loaded, case when c = 2 then split_part(line, ',', 1) end a, case when c = 2 then split_part(line, ',', 3) end p from n""")
def csv_quarantine(spark, sf_dir):
    lines = relation(spark, sf_dir, f"select {LINE} as line from {{orders}}")
    good, bad = files.split_lines(lines, "line", ["a", "s", "p"], "orders")
    loaded = good.select(F.concat_ws(",", "a", "s", "p").alias("line"), F.lit(True).alias("loaded"), "a", "p")
    return files.united([loaded, bad.select(F.col("raw_text").alias("line"), F.lit(False).alias("loaded"))])


def documents_as_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the documents as quoted CSV without a header, every eleventh short of a column."""
    quoted = F.concat(F.lit('"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    fields = F.when(F.col("doc_id") % 11 == 0, F.concat_ws(",", "doc_id", quoted)).otherwise(F.concat_ws(",", "doc_id", quoted, F.coalesce("source", F.lit(""))))
    path = files.scratch(spark, "csv")
    spark.read.parquet(f"{sf_dir}/documents.parquet").select(fields.alias("value")).write.text(path)
    return path


@query("""with d as (select doc_id, coalesce(text, '') t, coalesce(source, '') s from documents)
  select doc_id::varchar doc_id, doc_id % 11 <> 0 loaded, case when doc_id % 11 <> 0 then s end source, len(t) - len(replace(t, chr(10), '')) n_breaks,
  sha256(case when doc_id % 11 <> 0 then t else doc_id || ',"' || replace(t, '"', '""') || '"' end) text_sha256 from d""")
def csv_records_of_documents(spark, sf_dir):
    """Documents written as quoted CSV, with their own line ends and quotes, and read back; every eleventh lacks a column and is set apart as it stands."""
    path = documents_as_csv(spark, sf_dir)
    good, bad = files.csv_bronze(spark, [path], "documents", multi_line=True, names=["doc_id", "text", "source"])
    breaks = lambda c: (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))).cast("long")
    text = F.coalesce("text", F.lit(""))
    loaded = good.select("doc_id", F.lit(True).alias("loaded"), F.coalesce("source", F.lit("")).alias("source"), breaks(text).alias("n_breaks"), F.sha2(text, 256).alias("text_sha256"))
    raw = F.col("raw_text")
    apart = bad.select(F.substring_index(raw, ",", 1).alias("doc_id"), F.lit(False).alias("loaded"), F.lit(None).cast("string").alias("source"), breaks(raw).alias("n_breaks"), F.sha2(raw, 256).alias("text_sha256"))
    return loaded.unionByName(apart)


@query("""select 'V' || vec_id area_code, 'ring {' || vec_id || '"}' area_name, len(embedding) // 2 + 1 n_points,
  round(list_sum(list_transform(embedding[1:len(embedding) // 2 * 2], lambda x: round(x::double * 1000))) + round(embedding[1]::double * 1000) + round(embedding[2]::double * 1000)) total
  from embeddings where len(embedding) >= 6""")
def geojson_features_of_vectors(spark, sf_dir):
    """Vectors written as rings of whole coordinates, 50 to a collection, with braces and quotes in their names, and read back feature by feature."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter("size(embedding) >= 6")
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string"))
    n = F.floor(F.size("embedding") / 2).cast("int")
    corner = lambda k: F.concat(F.lit("["), F.get("v", 2 * k), F.lit(","), F.get("v", 2 * k + 1), F.lit("]"))
    ring = F.array_join(F.transform(F.concat(F.sequence(F.lit(0), n - 1), F.array(F.lit(0))), corner), ",")
    text = F.concat(F.lit('{"type":"Feature","properties":{"CD":"V'), "vec_id", F.lit('","NM":"ring {'), "vec_id", F.lit('\\"}"},"geometry":{"type":"Polygon","coordinates":[['), ring, F.lit("]]}}"))
    features = vectors.select("vec_id", "embedding", whole.alias("v")).select(F.floor(F.col("vec_id") / 50).alias("part"), text.alias("feature"))
    listed = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("feature"), ","), F.lit("]}"))
    path = files.scratch(spark, "geojson")
    features.groupBy("part").agg(listed.alias("value")).select("value").write.text(path)
    rows = files.geojson_features(spark, path, "CD", "NM", "2024")
    points = F.flatten(F.flatten("polygons"))
    total = F.aggregate(points, F.lit(0.0), lambda n, q: n + q["x"] + q["y"])
    return rows.select("area_code", "area_name", F.size(points).cast("long").alias("n_points"), F.round(total).alias("total"))


@query("""with d as (select doc_id, length(coalesce(text, '')) n, coalesce(source, '') s from documents), good as (select * from d where doc_id % 11 <> 0),
  l as (select l.*, l.doc_id in (select doc_id from good) link from labels l)
  select 'documents' source_id, 'source_rows' what, count(*) n from d union all select 'documents', 'bronze_rows', count(*) from good union all select 'documents', 'quarantine_rows', count(*) from d where doc_id % 11 = 0
  union all select 'documents', 'ledger:document_short', count(*) from good where n < 400 having count(*) > 0 union all select 'documents', 'rejected:length_valid', count(*) from good where n < 400
  union all select 'documents', 'ledger:document_first_source', count(*) from good where s = 'src0' having count(*) > 0
  union all select 'labels', 'source_rows', count(*) from labels union all select 'labels', 'bronze_rows', count(*) from labels union all select 'labels', 'quarantine_rows', 0
  union all select 'labels', 'rejected:link_valid', count(*) from l where not link union all select 'labels', 'ledger:label_orphan', count(*) from l where not link having count(*) > 0
  union all select 'labels', 'rejected:toxic_valid', count(*) from l where toxic is null or toxic = 1 union all select 'labels', 'ledger:label_toxic', count(*) from l where toxic is null or toxic = 1 having count(*) > 0
  union all select 'labels', 'missing:quality', count(*) from l where quality is null union all select 'documents', 'missing:n_chars', 0""")
def audited_build_of_documents(spark, sf_dir):
    """A whole build from files: documents read from quoted CSV, with labels as child rows; what its ledger and reports say."""
    path = documents_as_csv(spark, sf_dir)

    def documents(context):
        good, bad = files.csv_bronze(spark, [path], "documents", multi_line=True, names=["doc_id", "text", "source"], once=True)
        n = F.length(F.coalesce("text", F.lit("")))
        silver = lambda b: b.select("doc_id", n.alias("n_chars"), F.coalesce("source", F.lit("")).alias("source"), (n >= 400).alias("length_valid"), F.coalesce(F.col("source") == "src0", F.lit(False)).alias("first_source"))
        return contract.SourceResult(good, silver, bad, files.csv_source_rows(spark, [path], multi_line=True, header=False), {"n_chars": "numeric"})

    def labels(context):
        raw = spark.read.parquet(f"{sf_dir}/labels.parquet")
        text = raw.select(*(F.col(c).cast("string").alias(c) for c in ("doc_id", "quality", "toxic")))
        toxic = clean.coded("toxic", ["1"])
        keyed = lambda b: b.select("doc_id", clean.numeric("quality").alias("quality"), F.col("toxic").alias("toxic_raw"), toxic.alias("toxic"), toxic.isNotNull().alias("toxic_valid"))
        return contract.SourceResult(text, lambda b: stamps.with_link(keyed(b), context.silver("documents"), "doc_id", "doc_id"), cleaned={"quality": "numeric"})

    short = audit.Rule("document_short", "length_valid", "text", "n_chars", "short of 400 characters")
    web = audit.Rule("document_first_source", "first_source", "source", "source", "of the first source", warn=True)
    orphan = audit.Rule("label_orphan", "link_valid", "doc_id", "doc_id", "no such document")
    bad = audit.Rule("label_toxic", "toxic_valid", "toxic", "toxic_raw", "toxic")
    sources = [
        contract.Source("documents", documents, audit.SourceSpec("documents", "doc_id", (audit.Dimension("length_valid", ("document_short",), 1.0),), 0.5), (short, web)),
        contract.Source("labels", labels, audit.SourceSpec("labels", "doc_id", (audit.Dimension("link_valid", ("label_orphan",), 1.0), audit.Dimension("toxic_valid", ("label_toxic",), 1.0))), (orphan, bad), ("documents",)),
    ]
    t = contract.run(spark, sources, files.scratch(spark, "build"), {"tables": "documents, labels"})
    counts = t["ingest_report"].unpivot(["source_id"], ["source_rows", "bronze_rows", "quarantine_rows"], "what", "n")
    logged = t["data_quality_log"].groupBy("source_id", F.concat(F.lit("ledger:"), "rule_id").alias("what")).agg(F.count("*").alias("n"))
    rejected = t["reject_report"].select("source_id", F.concat(F.lit("rejected:"), "flag").alias("what"), F.col("n_rejected").alias("n"))
    missing = t["completeness"].select(F.col("tbl").alias("source_id"), F.concat(F.lit("missing:"), "col").alias("what"), F.col("n_missing").alias("n"))
    return files.united([counts, logged, rejected, missing])


@query("""select month, count(*) n, sum(round(v::double * 1000)::bigint * case when month = 3 then 2 else 1 end)::bigint total, min(day) first_day from (
  select vec_id % 12 + 1 as month, 1 + vec_id % 28 as day, unnest(embedding) v from embeddings where len(embedding) = 64) group by month""")
def months_of_vectors(spark, sf_dir):
    """Vectors as cubes of eight hours, merged into a grid by month; the third month comes again, doubled, and replaces its own."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter("size(embedding) = 64")
    start = F.make_timestamp_ntz(F.lit(2023), (F.col("vec_id") % 12 + 1).cast("int"), (1 + F.col("vec_id") % 28).cast("int"), F.lit(0), F.lit(0), F.lit(0))
    cubes = vectors.select(
        F.sequence(start, start + F.expr("interval 7 hours"), F.expr("interval 1 hour")).alias("valid_time"),
        F.array(F.lit(50.0), F.lit(50.1)).alias("lats"),
        F.array(*(F.lit(k / 10) for k in range(4))).alias("lons"),
        F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("long")).alias("v"),
    )
    path = files.scratch(spark, "grid")
    files.merge_months([cubes.withColumnRenamed("valid_time", "times"), cubes.limit(0)], ["v"], path)
    third = cubes.filter("month(valid_time[0]) = 3").withColumn("v", F.transform("v", lambda x: x * 2))
    files.merge_months([third], ["v"], path)
    rows = spark.read.parquet(path).withColumn("month", F.col("month").cast("long"))
    return rows.groupBy("month").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min(F.dayofmonth("time_utc")).cast("long").alias("first_day"))


@query("""select lower(trim(p_brand)) variable, cast(p_size as varchar) code, min(trim(p_type)) as "label", p_size % 7 = 0 is_missing from part group by 1, 2, 4""")
def lookup_of_parts(spark, sf_dir):
    """A code list written as CSV in order, and loaded again as a lookup: codes as text, is_missing as a boolean, each code once."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    listed = part.groupBy(F.lower(F.trim("p_brand")).alias("variable"), F.col("p_size").cast("string").alias("code"), (F.col("p_size") % 7 == 0).alias("is_missing"))
    listed = listed.agg(F.min(F.trim("p_type")).alias("label")).select("variable", "code", "label", "is_missing")
    path = files.scratch(spark, "codes")
    files.write_sorted_csv(listed, path, ["variable", "code"])
    return files.lookup(spark, path)


@query("""select 'nation-' || c_nationkey source_id, 'segment-' || c_mktsegment rule_id, count(*) + case when c_nationkey % 3 = 0 then 1000 else 0 end n
  from customer where c_nationkey % 3 = 0 or c_nationkey % 5 <> 0 group by c_nationkey, c_mktsegment""")
def audit_rows_rewritten(spark, sf_dir):
    """Shared audit rows of 25 sources, some of which are built again: a third get new rows, a fifth lose theirs, the rest keep what they had."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    rows = rows.select("c_nationkey", F.concat(F.lit("nation-"), "c_nationkey").alias("source_id"), F.concat(F.lit("segment-"), "c_mktsegment").alias("rule_id"), "n")
    path = files.scratch(spark, "audit")
    files.write_audit(rows.drop("c_nationkey"), path)
    again = rows.filter("c_nationkey % 3 = 0").withColumn("n", F.col("n") + 1000)
    files.write_audit(again.drop("c_nationkey"), path, [f"nation-{k}" for k in range(25) if k % 3 == 0 or k % 5 == 0])
    return spark.read.schema("rule_id string, n long, source_id string").parquet(path).select("source_id", "rule_id", "n")


WEATHER_CELLS = f"""cells as (select round(lat * 10)::int ca, round(lon * 10)::int cb, date_trunc('hour', {LONDON.format('time_utc')}) ch, min(tp * 1000) cp from grid group by all)"""


@query(with_({"ev": inputs.PLACED_EVENTS, "grid": inputs.GRID}, f""", {SUN_SQL}, {WEATHER_CELLS}
  select user_id % 10 as grp, count(*) n, round(sum(solar_elevation), 3) elevation_sum from sun join cells on ca = round(lat * 10)::int and cb = round(lon * 10)::int and ch = date_trunc('hour', {LONDON.format('ts')})
  where cp < 60 and solar_elevation between 0 and 15 and solar_azimuth between 45 and 135 group by 1""").replace("\n,", ",", 1))
def low_eastern_sun_in_dry_weather(spark, sf_dir):
    """Events under a low sun in the east while the weather grid says that little rain fell, by group of users."""
    grid = relation(spark, sf_dir, inputs.GRID).select(clean.grid_index("lat").alias("lat_idx"), clean.grid_index("lon").alias("lon_idx"), to_local("time_utc").alias("datetime_local"), clean.measured("tp", scale=1000.0).alias("precipitation_mm"))
    low = sun(spark, sf_dir).filter(F.col("solar_elevation").between(0, 15) & F.col("solar_azimuth").between(45, 135)).withColumn("datetime_local", to_local("ts"))
    dry = stamps.with_weather(low, grid, ["precipitation_mm"]).filter("precipitation_mm < 60")
    return dry.groupBy((F.col("user_id") % 10).alias("grp")).agg(F.count("*").alias("n"), F.round(F.sum("solar_elevation"), 3).alias("elevation_sum"))


@query("""select '0.1.0' "version", 1 schema_version, '{"mode": "snapshot", "years": [1995, 2001]}' parameters, count(*) n_orders from orders""")
def provenance_row(spark, sf_dir):
    """Versions and parameters, with the number of rows they stand for; all but the time of the build."""
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.count("*").alias("n_orders"))
    return audit.provenance(spark, "0.1.0", 1, {"years": [1995, 2001], "mode": "snapshot"}).drop("built_at_utc").join(n, F.lit(True))
