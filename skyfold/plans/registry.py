"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle per operator family of the inventory.  Every query reads the
driver's tables through the views of ``skyfold.sources.testdata``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window

from skyfold.plans import oracle_sql as O
from skyfold.sources.testdata import Tables, duck_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def maintained(t: Tables, name: str, source: str, build) -> DataFrame:
    """A maintained table of the serving path, as Parquet in the shared folder.

    It is built when the input ``source`` is first met and again when the files
    of that input change (their paths, sizes and times name the folder); later
    requests read it with pushed filters.  The build is a query of its own
    (``w1_latest_table``); a deployment runs it, or the stream, on its schedule."""
    import hashlib

    from skyfold.session import shared_path
    spark = t.spark
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{t.sf_dir}/{source}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in fs.listStatus(path))
    mark = hashlib.sha256("\n".join([spark.sparkContext.applicationId, *files]).encode()).hexdigest()[:24]
    out = shared_path(spark, f"tables/{name}-{mark}")
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out, "_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        build(out)
    return spark.read.parquet(out)


def latest_of(t: Tables):
    """The maintained latest table (one row per aircraft)."""
    from skyfold.sources.sinks import write_latest
    return maintained(t, "latest", "events", lambda out: write_latest(build_latest(t.positions), out))


# ---------------------------------------------------------------- Q1 map list
from skyfold.operators.latest import build_latest  # noqa: E402
from skyfold.plans.flights import list_flights, list_summary  # noqa: E402

_Q1_BASE = duck_ctes("positions", "aircraft") + ", " + O.LATEST_CTE + O.snapshot_ctes(with_owner=False)


@register("q1_list_flights", _Q1_BASE + f"""
select {O.MAP_ITEM_SELECT} from snap
order by last_contact desc nulls last, icao24 desc limit 200""")
def q1_list_flights(spark, sf):
    t = tables(spark, sf)
    return list_flights(latest_of(t), t.aircraft)


@register("q1_list_flights_filtered", _Q1_BASE + f"""
, items AS (select {O.MAP_ITEM_SELECT} from snap
  where military_hint = false and airframe_type = 'airplane')
select * from items order by speed asc nulls first, icao24 asc limit 25""")
def q1_list_flights_filtered(spark, sf):
    t = tables(spark, sf)
    return list_flights(latest_of(t), t.aircraft, limit=25, sort="speed", order="asc",
                        military="false", airframe="airplane")


@register("q1_list_summary", _Q1_BASE + """
select least(count(*), 200) as count, count(*) as total_matched, 200 as "limit",
       max(batch_epoch) as latest_batch_epoch from snap""")
def q1_list_summary(spark, sf):
    t = tables(spark, sf)
    return list_summary(latest_of(t), t.aircraft)


# ---------------------------------------------------------------- Q3 / Q5 metrics
from pyspark.sql import functions as F  # noqa: E402

from skyfold.functions.taxonomy import FLEET_ORDER, SIZE_ORDER  # noqa: E402
from skyfold.operators.activity import activity_buckets  # noqa: E402
from skyfold.operators.enrich import enrich_events  # noqa: E402
from skyfold.operators.metrics import enrichment_coverage, events_by_attribute  # noqa: E402
from skyfold.plans.metrics import flights_metrics, kpi_totals  # noqa: E402


def now_epoch(positions) -> int:
    """``now`` for reproducible answers: the newest last_contact (one scalar)."""
    return int(positions.agg(F.max("last_contact")).first()[0])


def _metrics(spark, sf):
    t = tables(spark, sf)
    return flights_metrics(latest_of(t), t.positions, t.aircraft, now_epoch(t.positions))


_NOW = "(select max(last_contact) from positions)"
_AREA = ("(greatest(0.0, ((49.7575 - 47.9557) * 110.574) * ((3.7221 - 0.9823) * 111.320"
         " * cos(radians((47.9557 + 49.7575) / 2.0)))))")
_Q3_BASE = (duck_ctes("positions", "aircraft") + ", " + O.LATEST_CTE
            + O.snapshot_ctes(with_owner=True, since_sql=f"{_NOW} - 86400") + f""",
snapc AS (select *, {O.fleet_sql('military_hint', 'callsign', 'category', 'owner_operator')} as fleet_type,
    {O.size_sql('category', 'typecode')} as aircraft_size,
    {O.type_label_sql('category', 'typecode')} as type_label from snap),
tot AS (select count(*) as total from snapc)
""")


def _breakdown_sql(col: str, canon: list[str]) -> str:
    vals = ", ".join(f"('{k}', {i})" for i, k in enumerate(canon))
    return _Q3_BASE + f""",
counts AS (select {col} as key, count(*) as count from snapc group by 1),
canon AS (select * from (values {vals}) t(key, ordinal))
select coalesce(c.key, k.key) as key, coalesce(c.count, 0) as count,
       {O.round2_sql('case when tot.total > 0 then coalesce(c.count, 0) * 100.0 / tot.total else 0.0 end')} as percent,
       coalesce(k.ordinal, {len(canon)}) as ordinal
from counts c full join canon k on c.key = k.key cross join tot"""


@register("q3_kpis", _Q3_BASE + f"""
select count(*) as active_aircraft,
       case when {_AREA} > 0 then {O.round2_sql(f'count(*) / {_AREA} * 10000.0')} else 0.0 end as traffic_density,
       {O.round2_sql('case when count(*) > 0 then count_if(coalesce(military_hint, false)) * 100.0 / count(*) else 0.0 end')} as military_share,
       {O.round2_sql('case when count(*) > 0 then count_if(coalesce(military_hint, false)) * 100.0 / count(*) else 0.0 end')} as defense_score,
       cast(1800 as bigint) as activity_bucket_seconds, cast(86400 as bigint) as activity_window_seconds
from snapc""")
def q3_kpis(spark, sf):
    return _metrics(spark, sf).kpis


@register("q3_fleet_breakdown", _breakdown_sql("fleet_type", FLEET_ORDER))
def q3_fleet_breakdown(spark, sf):
    return _metrics(spark, sf).fleet


@register("q3_size_breakdown", _breakdown_sql("aircraft_size", SIZE_ORDER))
def q3_size_breakdown(spark, sf):
    return _metrics(spark, sf).sizes


@register("q3_aircraft_types", _Q3_BASE + f"""
select key, count, {O.round2_sql('case when tot.total > 0 then count * 100.0 / tot.total else 0.0 end')} as percent
from (select type_label as key, count(*) as count from snapc group by 1
      order by count desc, key asc limit 8) cross join tot""")
def q3_aircraft_types(spark, sf):
    return _metrics(spark, sf).types


_EV_ENRICHED = duck_ctes("positions", "aircraft") + """,
ev AS (select p.*, a.icao24 is not null as has_metadata,
          case when nullif(trim(a.category_description), '') is not null then a.category_description
               when nullif(trim(a.icao_aircraft_class), '') is not null then a.icao_aircraft_class
               else 'unknown' end as category,
          a.country, a.typecode, a.military_hint, a.year_built, a.owner_operator
       from positions p left join aircraft a on lower(trim(p.icao24)) = lower(trim(a.icao24))
       where p.icao24 is not null)
"""


def _minutes_sql(width: int) -> str:
    return f"""select (last_contact // {width}) * {width} as bucket_epoch, count(*) as events_total,
       cast(count_if(coalesce(military_hint, false)) as bigint) as events_military,
       count(distinct icao24) as aircraft_total,
       count(distinct case when coalesce(military_hint, false) then icao24 end) as aircraft_military
from ev where last_contact is not null group by 1"""


_SERIES_SQL = _EV_ENRICHED + f""",
minutes AS ({_minutes_sql(60)}),
p AS (select {_NOW} - 86400 as start, cast(1800 as bigint) as width, {_NOW} as now),
m AS (select least(47, case when bucket_epoch - p.start < 0 then 0
                            else (bucket_epoch - p.start) // p.width end) as idx, minutes.*
      from minutes, p
      where bucket_epoch >= (p.start // 60) * 60 and bucket_epoch <= p.now),
agg AS (select idx, sum(events_total) as events_total, sum(events_military) as events_military,
               sum(aircraft_total) as aircraft_total, sum(aircraft_military) as aircraft_military,
               count(*) as observed from m group by idx),
grid AS (select range as idx, p.start + range * p.width as bucket_start from range(48), p),
series AS (
  select g.idx, g.bucket_start, cast(coalesce(a.events_total, 0) as bigint) as events_total,
       cast(coalesce(a.events_military, 0) as bigint) as events_military,
       cast(coalesce(a.aircraft_total, 0) as bigint) as aircraft_total,
       cast(coalesce(a.aircraft_military, 0) as bigint) as aircraft_military,
       {O.round2_sql('case when coalesce(a.aircraft_total, 0) > 0 then coalesce(a.aircraft_military, 0) * 100.0 / a.aircraft_total else 0.0 end')} as military_share_pct,
       coalesce(a.observed, 0) > 0 as has_data
  from grid g left join agg a on g.idx = a.idx)
"""


@register("q3_activity_series", _SERIES_SQL + "select * from series")
def q3_activity_series(spark, sf):
    return _metrics(spark, sf).series


@register("q5_kpi_totals", _SERIES_SQL.replace("WITH ", "WITH ", 1)
          + ", " + O.LATEST_CTE + O.snapshot_ctes(with_owner=True, since_sql=f"{_NOW} - 86400") + f""",
snapc AS (select *, {O.fleet_sql('military_hint', 'callsign', 'category', 'owner_operator')} as fleet_type from snap),
fleet AS (select key, coalesce(c.count, 0) as count, k.ordinal from
   (select * from (values {", ".join(f"('{k}', {i})" for i, k in enumerate(FLEET_ORDER))}) t(key, ordinal)) k
   left join (select fleet_type as fk, count(*) as count from snapc group by 1) c on c.fk = k.key
   union all select fleet_type, count(*), {len(FLEET_ORDER)} from snapc
   where fleet_type not in ({", ".join(f"'{k}'" for k in FLEET_ORDER)}) group by 1),
known AS (select avg(case when has_data then aircraft_total end) as a,
                 avg(case when has_data then aircraft_military end) as am from series),
filled AS (select s.*, case when not has_data and known.a is not null
                  then greatest(0, floor(known.a + 0.5)) else aircraft_total end as filled,
                  not has_data and known.a is not null as imputed,
                  not has_data and known.am is not null as imputed_m from series s, known)
select cast(sum(events_total) as bigint) as total_events,
       cast(sum(aircraft_military) as bigint) as military_aircraft_sum,
       cast(count_if(imputed) as bigint) as imputed_buckets,
       cast(count_if(imputed_m) as bigint) as imputed_military_buckets,
       cast(greatest(coalesce(max(filled), 0), (select count(*) from snapc), 1) as bigint) as peak,
       (select key from fleet order by count desc, ordinal asc, key asc limit 1) as dominant_fleet
from filled""")
def q5_kpi_totals(spark, sf):
    return kpi_totals(_metrics(spark, sf))


@register("q5_kpi_strip", ORACLES["q5_kpi_totals"].split("select cast(sum(events_total)")[0] + f""",
sizes AS (select key, coalesce(c.count, 0) as count, k.ordinal from
   (select * from (values {", ".join(f"('{k}', {i})" for i, k in enumerate(SIZE_ORDER))}) t(key, ordinal)) k
   left join (select {O.size_sql('category', 'typecode')} as sk, count(*) as count from snap group by 1) c on c.sk = k.key),
types AS (select {O.type_label_sql('category', 'typecode')} as key, count(*) as count from snap group by 1)
select * from (select 'top_fleet' as part, row_number() over (order by count desc, ordinal) as position, key,
        cast(count as bigint) as value from fleet) where position <= 3
union all select * from (select 'top_sizes', row_number() over (order by count desc, ordinal) as position, key,
        cast(count as bigint) from sizes) where position <= 3
union all select * from (select 'top_types', row_number() over (order by count desc, key) as position, key,
        cast(count as bigint) from types) where position <= 3
union all select 'series', idx, case when imputed then 'imputed' else 'measured' end, cast(filled as bigint) from filled""")
def q5_kpi_strip(spark, sf):
    from skyfold.plans.metrics import kpi_strip_rows
    return kpi_strip_rows(_metrics(spark, sf))


@register("a7_activity_buckets_hourly", _EV_ENRICHED + "select * from (" + _minutes_sql(3600) + ")")
def a7_activity_buckets_hourly(spark, sf):
    t = tables(spark, sf)
    ev = enrich_events(t.positions.where(F.col("icao24").isNotNull()), t.aircraft)
    return activity_buckets(ev, 3600)


@register("a12_events_by_attribute", _EV_ENRICHED + """,
lab AS (select
    case when has_metadata and nullif(trim(category), '') is not null then category else 'unknown' end as cat,
    case when has_metadata and nullif(trim(country), '') is not null then trim(country) else 'unknown' end as country,
    case when not has_metadata or military_hint is null then 'unknown'
         when military_hint then 'true' else 'false' end as mil,
    case when nullif(trim(typecode), '') is null or length(trim(typecode)) > 8 then 'unknown'
         else upper(trim(typecode)) end as tc
  from ev)
select 'category' as attribute, cat as value, count(*) as events from lab group by 2
union all select 'country', country, count(*) from lab group by 2
union all select 'military', mil, count(*) from lab group by 2
union all select 'military_typecode', tc, count(*) from lab where mil = 'true' group by 2""")
def a12_events_by_attribute(spark, sf):
    t = tables(spark, sf)
    return events_by_attribute(enrich_events(t.positions.where(F.col("icao24").isNotNull()), t.aircraft))


@register("a13_enrichment_coverage", _EV_ENRICHED + """
select 'year_built' as field, case when has_metadata and year_built is not null then 'present'
       else 'missing' end as status, count(*) as events from ev group by 2
union all
select 'owner_operator', case when has_metadata and coalesce(trim(owner_operator) <> '', false)
       then 'present' else 'missing' end, count(*) from ev group by 2""")
def a13_enrichment_coverage(spark, sf):
    t = tables(spark, sf)
    return enrichment_coverage(enrich_events(t.positions.where(F.col("icao24").isNotNull()), t.aircraft))


# ---------------------------------------------------------------- per-aircraft state
from skyfold.functions import expr as X  # noqa: E402
from skyfold.functions.taxonomy import (aircraft_size, aircraft_type_label, airframe_type,  # noqa: E402
                                        fleet_type, normalized_columns)
from skyfold.operators.enrich import aircraft_dim, enrich  # noqa: E402
from skyfold.operators.filters import Bbox, classify_bbox, continuity_window, in_bbox  # noqa: E402
from skyfold.operators.latest import (current_members, latest_by_last_seen,  # noqa: E402
                                      latest_per_aircraft, membership_changes, recent_track,
                                      with_previous)

_ASC = "last_contact asc nulls first, batch_epoch asc nulls first, event_id asc"
_POS = duck_ctes("positions", "aircraft")


@register("a1_latest_per_aircraft", _POS + """
select * exclude (r) from (select *, row_number() over (partition by lower(trim(icao24))
   order by batch_epoch desc nulls last, last_contact desc nulls last, event_id desc) as r
 from positions where icao24 is not null) where r = 1""")
def a1_latest_per_aircraft(spark, sf):
    return latest_per_aircraft(tables(spark, sf).positions)


@register("a2_latest_by_last_seen", _POS + """
select * exclude (r) from (select *, row_number() over (partition by icao24
   order by last_contact desc nulls last, event_id desc) as r
 from positions where lat is not null and lon is not null and trim(icao24) <> '') where r = 1""")
def a2_latest_by_last_seen(spark, sf):
    """The ids arrive in mixed case and with blanks around them."""
    raw = F.when(F.col("event_id") % 3 == 0, F.upper("icao24")).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit(" \t"), F.col("icao24"), F.lit(" "))).otherwise(F.col("icao24"))
    return latest_by_last_seen(tables(spark, sf).positions.withColumn("icao24", raw))


@register("a11_latest_batch_epoch", _POS + "select max(batch_epoch) as latest_batch_epoch from positions")
def a11_latest_batch_epoch(spark, sf):
    from skyfold.operators.latest import latest_batch_epoch
    return latest_batch_epoch(tables(spark, sf).positions)


@register("w1_with_previous", _POS + f"""
select event_id, icao24, last_contact,
  lag(lat) over w as prev_lat, lag(lon) over w as prev_lon, lag(heading) over w as prev_heading,
  lag(velocity) over w as prev_velocity, lag(coalesce(geo_altitude, baro_altitude)) over w as prev_altitude,
  lag(last_contact) over w as prev_last_contact
from positions where icao24 is not null window w as (partition by icao24 order by {_ASC})""")
def w1_with_previous(spark, sf):
    p = tables(spark, sf).positions.where(F.col("icao24").isNotNull())
    return with_previous(p).select("event_id", "icao24", "last_contact", "prev_lat", "prev_lon",
                                   "prev_heading", "prev_velocity", "prev_altitude", "prev_last_contact")


@register("w1_latest_table", _POS + ", " + O.LATEST_CTE + " select * from latest")
def w1_latest_table(spark, sf):
    return build_latest(tables(spark, sf).positions)


@register("w2_recent_track", _POS + f"""
select icao24, event_id, last_contact, rank from (select icao24, event_id, last_contact,
  row_number() over (partition by icao24 order by {O.EVENT_ORDER_DESC}) as rank from positions)
where rank <= 20""")
def w2_recent_track(spark, sf):
    return recent_track(tables(spark, sf).positions, n=20).select(
        "icao24", "event_id", "last_contact", F.col("rank").cast("long").alias("rank"))


_K_SQL = _POS + f""",
k AS (select icao24, last_contact, batch_epoch, event_id, {O.bbox_sql()} as inside
      from positions where lat is not null and lon is not null)
"""


@register("w17_membership_changes", _K_SQL + f"""
select icao24, last_contact, batch_epoch, event_id, case when inside then 'enter' else 'leave' end as change
from (select *, lag(inside) over (partition by icao24 order by {_ASC}) as was from k)
where (was is null and inside) or was <> inside""")
def w17_membership_changes(spark, sf):
    return membership_changes(tables(spark, sf).positions, Bbox.default())


@register("w17_current_members", _K_SQL + f"""
select icao24 from (select icao24, inside, row_number() over (partition by icao24
   order by {O.EVENT_ORDER_DESC}) as r from k) where r = 1 and inside""")
def w17_current_members(spark, sf):
    return current_members(tables(spark, sf).positions, Bbox.default())


@register("f2_classify_bbox_counts", _POS + f"""
select case when lat is null or lon is null then 'UNKNOWN' when {O.bbox_sql()} then 'INSIDE'
            else 'OUTSIDE' end as bbox_class, count(*) as events from positions group by 1""")
def f2_classify_bbox_counts(spark, sf):
    p = tables(spark, sf).positions
    return p.groupBy(classify_bbox(Bbox.default()).alias("bbox_class")).agg(F.count(F.lit(1)).alias("events"))


@register("f8_continuity_window", _POS + f""",
cand AS (select * from positions where {O.bbox_sql()})
select event_id, icao24, batch_epoch from cand
where batch_epoch in (select distinct batch_epoch from cand where batch_epoch is not null
                      order by batch_epoch desc limit 3)
   or not exists (select 1 from cand where batch_epoch is not null)""")
def f8_continuity_window(spark, sf):
    cand = tables(spark, sf).positions.where(in_bbox(Bbox.default()))
    return continuity_window(cand).select("event_id", "icao24", "batch_epoch")


@register("x_taxonomy_aircraft", _POS + f"""
select lower(trim(icao24)) as icao24,
  {O.airframe_sql('category', 'typecode')} as airframe_type,
  {O.fleet_sql('military_hint', 'cast(null as varchar)', 'category', 'owner_operator')} as fleet_type,
  {O.size_sql('category', 'typecode')} as aircraft_size,
  {O.type_label_sql('category', 'typecode')} as type_label
from (select icao24, military_hint, owner_operator, upper(nullif(trim(typecode), '')) as typecode,
        case when nullif(trim(category_description), '') is not null then category_description
             when nullif(trim(icao_aircraft_class), '') is not null then icao_aircraft_class end as category
      from aircraft)""")
def x_taxonomy_aircraft(spark, sf):
    d = normalized_columns(aircraft_dim(tables(spark, sf).aircraft, with_owner=True)
                           .withColumn("callsign", F.lit(None).cast("string")))
    return d.select(F.col("_ak").alias("icao24"), "airframe_type",
                    fleet_type("military_hint", "_cs", "_cat", "_own", normalized=True).alias("fleet_type"),
                    aircraft_size("_cat", "_tc", normalized=True).alias("aircraft_size"),
                    aircraft_type_label("category", "typecode").alias("type_label"))


@register("x2_fleet_type_latest", _POS + ", " + O.LATEST_CTE + f""",
dim AS (select lower(trim(icao24)) as ak,
        case when nullif(trim(category_description), '') is not null then category_description
             when nullif(trim(icao_aircraft_class), '') is not null then icao_aircraft_class end as category,
        military_hint, owner_operator from aircraft)
select l.icao24, l.callsign, {O.fleet_sql('m.military_hint', 'l.callsign', 'm.category', 'm.owner_operator')}
  as fleet_type from latest l left join dim m on l.icao24 = m.ak""")
def x2_fleet_type_latest(spark, sf):
    t = tables(spark, sf)
    e = normalized_columns(enrich(build_latest(t.positions), t.aircraft, with_owner=True))
    return e.select("icao24", "callsign",
                    fleet_type("military_hint", "_cs", "_cat", "_own", normalized=True).alias("fleet_type"))


def _r6(x: str) -> str:
    return f"(floor(({x}) * 1000000.0 + 0.5) / 1000000.0)"


@register("n_expressions", _POS + f""",
w AS (select *, lag(lat) over w as plat, lag(lon) over w as plon, lag(heading) over w as phead,
        lag(velocity) over w as pvel
      from positions where icao24 is not null window w as (partition by icao24 order by {_ASC}))
select event_id,
  coalesce(geo_altitude, baro_altitude) as altitude,
  {_r6('2 * 6371.0 * atan2(sqrt(sin(radians(lat - plat) / 2) ** 2 + cos(radians(plat)) * cos(radians(lat)) * sin(radians(lon - plon) / 2) ** 2), sqrt(1 - (sin(radians(lat - plat) / 2) ** 2 + cos(radians(plat)) * cos(radians(lat)) * sin(radians(lon - plon) / 2) ** 2)))')} as dist_km,
  {_r6('case when plat is null or lat is null then lat else plat + (lat - plat) * 0.5 end')} as mid_lat,
  {_r6('case when phead is null or heading is null then heading else (((phead + ((((heading - phead + 540.0) % 360.0) - 180.0)) * 0.5) % 360.0) + 360.0) % 360.0 end')} as mid_heading,
  floor(velocity * 1.852 * 10.0 + 0.5) / 10.0 as speed_kmh,
  {O.round2_sql('velocity / 3.0')} as round2_third,
  case when velocity > 0 then {_r6('(heading * 100.0) / velocity')} else 0.0 end as pct_value
from w""")
def n_expressions(spark, sf):
    p = tables(spark, sf).positions.where(F.col("icao24").isNotNull())
    from pyspark.sql import Window
    w = Window.partitionBy("icao24").orderBy(
        *[F.col(c).asc_nulls_first() for c in ("last_contact", "batch_epoch", "event_id")])
    d = p.select("*", F.lag("lat").over(w).alias("plat"), F.lag("lon").over(w).alias("plon"),
                 F.lag("heading").over(w).alias("phead"))
    r6 = lambda c: F.floor(c * 1000000.0 + 0.5) / 1000000.0
    return d.select(
        "event_id", X.altitude().alias("altitude"),
        r6(X.haversine_km("plat", "plon", "lat", "lon")).alias("dist_km"),
        r6(X.lerp("plat", "lat", F.lit(0.5))).alias("mid_lat"),
        r6(X.lerp_heading("phead", "heading", F.lit(0.5))).alias("mid_heading"),
        r6(X.knots_to_kmh("velocity")).alias("speed_kmh"),
        X.round2(F.col("velocity") / 3.0).alias("round2_third"),
        r6(X.pct("heading", "velocity")).alias("pct_value"))


@register("n_aircraft_labels", _POS + """
select lower(trim(icao24)) as icao24,
  case when nullif(trim(category_description), '') is not null then category_description
       when nullif(trim(icao_aircraft_class), '') is not null then icao_aircraft_class
       else 'unknown' end as category_label,
  case when military_hint is null then 'unknown' when military_hint then 'true' else 'false' end as military_label,
  case when nullif(trim(typecode), '') is null or length(trim(typecode)) > 8 then 'unknown'
       else upper(trim(typecode)) end as typecode_label,
  case when nullif(trim(country), '') is not null then trim(country) else 'unknown' end as country_label,
  case when regexp_matches(lower(trim(icao24)), '^[0-9a-f]{6}$') then lower(trim(icao24)) end as icao_valid
from aircraft""")
def n_aircraft_labels(spark, sf):
    a = tables(spark, sf).aircraft
    return a.select(X.norm_icao24("icao24", validate=False).alias("icao24"),
                    X.category_or_fallback().alias("category_label"),
                    X.military_label().alias("military_label"),
                    X.sanitize_typecode().alias("typecode_label"),
                    X.counter_label("country", trim=True).alias("country_label"),
                    X.norm_icao24("icao24").alias("icao_valid"))


@register("n7_since_parsing", _POS + """
select event_id, case event_id % 8 when 7 then null when 6 then (last_contact // 60) * 60 else last_contact end as parsed,
       event_id % 8 = 7 as unreadable from positions""")
def n7_since_parsing(spark, sf):
    """Epoch seconds and milliseconds, leading zeros, offset date-times without
    seconds or with nine fraction digits, and unreadable input."""
    p = tables(spark, sf).positions
    t, kind = F.timestamp_seconds("last_contact"), F.col("event_id") % 8
    iso = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    raw = (F.when(kind == 0, F.col("last_contact").cast("string"))
           .when(kind == 1, (F.col("last_contact") * 1000 + F.col("event_id") % 1000).cast("string"))
           .when(kind == 2, F.concat(F.lit("000000000000"), F.col("last_contact")))
           .when(kind == 3, F.concat(F.lit("  "), iso, F.lit("Z\t")))
           .when(kind == 4, F.concat(iso, F.lit(".123456789Z")))
           .when(kind == 5, F.concat(F.date_format(t + F.expr("interval 2 hours"), "yyyy-MM-dd't'HH:mm:ss"), F.lit("+02:00")))
           .when(kind == 6, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm"), F.lit("z")))
           .otherwise(F.when(F.col("event_id") % 16 == 7, iso).otherwise(F.lit("99999999999999999999"))))
    return p.select("event_id", X.epoch_or_iso_to_epoch(raw).alias("parsed"), X.unreadable_epoch(raw).alias("unreadable"))


@register("n4_years", """
select p_partkey, case when (1880 + p_partkey % 240) between 1900 and 2100 and p_partkey % 7 <> 6
       then cast(1880 + p_partkey % 240 as integer) end as year from part""")
def n4_years(spark, sf):
    """Years with any number of leading zeros, quoted, and with junk."""
    y, k = (1880 + F.col("p_partkey") % 240).cast("string"), F.col("p_partkey")
    raw = F.when(k % 7 == 6, F.concat(y, F.lit("x"))).when(k % 7 == 5, F.concat(F.lit('"'), y, F.lit('"'))).otherwise(
        F.concat(F.expr("repeat('0', cast(p_partkey % 30 as int))"), y))
    return tables(spark, sf).part.select("p_partkey", X.to_year(raw).alias("year"))


@register("n16_n17_zone_areas", """
select n_nationkey as zone,
  {deg} as area_deg2, {km} as area_km2,
  {smnlo} as scaled_min_lon, {smnla} as scaled_min_lat, {smxlo} as scaled_max_lon, {smxla} as scaled_max_lat
from (select n_nationkey, -5.0 + n_nationkey * 0.5 as mnlo, 40.0 + n_nationkey * 0.3 as mnla,
             -5.0 + n_nationkey * 0.5 + 1.0 + n_regionkey as mxlo, 40.0 + n_nationkey * 0.3 + 0.5 + n_regionkey * 0.25 as mxla,
             cast(n_regionkey as double) as factor from nation)""".format(
    deg=_r6("greatest(0.0, (mxlo - mnlo) * (mxla - mnla))"),
    km=_r6("greatest(0.0, (greatest(0.0, mxla - mnla) * 110.574) * (greatest(0.0, mxlo - mnlo) * 111.320 * cos(radians((mnla + mxla) / 2.0))))"),
    smnlo=_r6("greatest(-180.0, (mnlo + mxlo) / 2.0 - (mxlo - mnlo) / 2.0 * sqrt(greatest(1.0, factor)))"),
    smnla=_r6("greatest(-90.0, (mnla + mxla) / 2.0 - (mxla - mnla) / 2.0 * sqrt(greatest(1.0, factor)))"),
    smxlo=_r6("least(180.0, (mnlo + mxlo) / 2.0 + (mxlo - mnlo) / 2.0 * sqrt(greatest(1.0, factor)))"),
    smxla=_r6("least(90.0, (mnla + mxla) / 2.0 + (mxla - mnla) / 2.0 * sqrt(greatest(1.0, factor)))")))
def n16_n17_zone_areas(spark, sf):
    n = tables(spark, sf).nation
    z = n.select(F.col("n_nationkey").alias("zone"),
                 (F.lit(-5.0) + F.col("n_nationkey") * 0.5).alias("mnlo"),
                 (F.lit(40.0) + F.col("n_nationkey") * 0.3).alias("mnla"),
                 (F.lit(-5.0) + F.col("n_nationkey") * 0.5 + 1.0 + F.col("n_regionkey")).alias("mxlo"),
                 (F.lit(40.0) + F.col("n_nationkey") * 0.3 + 0.5 + F.col("n_regionkey") * 0.25).alias("mxla"),
                 F.col("n_regionkey").cast("double").alias("factor"))
    r6 = lambda c: F.floor(c * 1000000.0 + 0.5) / 1000000.0
    s = X.scale_bbox("mnlo", "mnla", "mxlo", "mxla", "factor")
    return z.select("zone", r6(X.bbox_area_deg2("mnlo", "mnla", "mxlo", "mxla")).alias("area_deg2"),
                    r6(X.bbox_area_km2("mnlo", "mnla", "mxlo", "mxla")).alias("area_km2"),
                    r6(s["min_lon"]).alias("scaled_min_lon"), r6(s["min_lat"]).alias("scaled_min_lat"),
                    r6(s["max_lon"]).alias("scaled_max_lon"), r6(s["max_lat"]).alias("scaled_max_lat"))


# ---------------------------------------------------------------- tracks and motion
from skyfold.operators.metrics import feed_freshness, median_batch_gap  # noqa: E402
from skyfold.operators.motion import batch_durations, interpolate_positions, motion_plan  # noqa: E402
from skyfold.operators.tracks import static_aircraft, track_points, track_report, track_segments  # noqa: E402
from skyfold.plans.flights import filtered_snapshots, to_map_item  # noqa: E402

_PTS = _POS + """,
pts AS (select icao24, event_id, lat, lon, last_contact as last_seen, on_ground from positions
        where lat is not null and lon is not null and last_contact is not null)
"""


def _segments_sql(src: str, keys: str, gap: int) -> str:
    return f"""
seg0 AS (select *, case when lag(last_seen) over w is null
             or abs(last_seen - lag(last_seen) over w) > {gap} then 1 else 0 end as brk
         from {src} window w as (partition by {keys} order by last_seen, event_id)),
seg1 AS (select *, sum(brk) over (partition by {keys} order by last_seen, event_id
             rows between unbounded preceding and current row) as segment from seg0),
seg AS (select * exclude (brk), count(*) over (partition by {keys}, segment) as segment_points from seg1)"""


@register("w3_track_segments", _PTS + "," + _segments_sql("pts", "icao24", 14400) + """
select icao24, event_id, last_seen, cast(segment as bigint) as segment, segment_points from seg
where segment_points >= 2""")
def w3_track_segments(spark, sf):
    pts = track_points(tables(spark, sf).positions)
    return track_segments(pts, 14400, split_seconds=86400).select(
        "icao24", "event_id", "last_seen", F.col("segment").cast("long").alias("segment"), "segment_points")


@register("q6_track_report", _POS + f""",
recent AS (select * from (select *, row_number() over (partition by icao24 order by {O.EVENT_ORDER_DESC}) as rk
           from positions) where rk <= 120),
pts AS (select icao24, event_id, lat, lon, last_contact as last_seen, on_ground from recent
        where lat is not null and lon is not null and last_contact is not null),
tk AS (select *, lag(on_ground) over (partition by icao24 order by last_seen, event_id) as pog from pts),
sided0 AS (select *, max(case when pog is not distinct from true and on_ground is not distinct from false
                    then last_seen end) over (partition by icao24) as takeoff,
              max(last_seen) over (partition by icao24) as latest,
              count(*) over (partition by icao24) as n from tk),
sided AS (select icao24, event_id, lat, lon, last_seen, on_ground,
            case when last_seen >= coalesce(takeoff, latest - 259200) then 'current' else 'historical' end as side
          from sided0 where n >= 2),
{_segments_sql('sided', 'icao24, side', 43200)}
select icao24, side, event_id, last_seen, lat, lon, cast(segment as bigint) as segment, segment_points
from seg where segment_points >= 2""")
def q6_track_report(spark, sf):
    r = track_report(tables(spark, sf).positions, 120, gap_seconds=43200, fallback_seconds=259200)
    return r.select("icao24", "side", "event_id", "last_seen", "lat", "lon",
                    F.col("segment").cast("long").alias("segment"), "segment_points")


@register("w5_static_aircraft", _POS + f""",
snap AS (select icao24, batch_epoch, lat, lon from (select *, row_number() over (partition by icao24, batch_epoch
           order by last_contact desc nulls last, event_id desc) as r from positions
           where lat is not null and lon is not null and batch_epoch is not null) where r = 1),
b AS (select batch_epoch, lag(batch_epoch) over (order by batch_epoch) as global_prev
      from (select distinct batch_epoch from snap)),
d AS (select s.*, lag(batch_epoch) over w as own_prev, lag(lat) over w as plat, lag(lon) over w as plon
      from snap s window w as (partition by icao24 order by batch_epoch)),
m AS (select d.*, b.global_prev, own_prev is not null and own_prev = b.global_prev as adj,
        2 * 6371.0 * atan2(sqrt(sin(radians(lat - plat) / 2) ** 2 + cos(radians(plat)) * cos(radians(lat)) * sin(radians(lon - plon) / 2) ** 2),
                           sqrt(1 - (sin(radians(lat - plat) / 2) ** 2 + cos(radians(plat)) * cos(radians(lat)) * sin(radians(lon - plon) / 2) ** 2))) as km
      from d join b using (batch_epoch))
select icao24, batch_epoch, {_r6('case when adj then km end')} as moved_km,
       coalesce(adj and km <= 0.05, false) as is_static from m""")
def w5_static_aircraft(spark, sf):
    s = static_aircraft(tables(spark, sf).positions)
    return s.select("icao24", "batch_epoch",
                    (F.floor(F.col("moved_km") * 1000000.0 + 0.5) / 1000000.0).alias("moved_km"), "is_static")


@register("w9_batch_durations", _POS + """
select batch_epoch, previous_batch, cast(case when previous_batch is not null and batch_epoch > previous_batch
   then least(20000, greatest(1000, (batch_epoch - previous_batch) * 1000)) else 10000 end as bigint) as duration_ms
from (select batch_epoch, lag(batch_epoch) over (order by batch_epoch) as previous_batch
      from (select distinct batch_epoch from positions where batch_epoch is not null))""")
def w9_batch_durations(spark, sf):
    return batch_durations(tables(spark, sf).positions)


_ITEMS = _Q1_BASE + f""",
items AS (select {O.MAP_ITEM_SELECT} from snap),
st AS (select *, lat is not null and lon is not null and prev_lat is not null and prev_lon is not null
          and not coalesce(last_seen < prev_last_seen, false) as use from items)
"""


def _items(spark, sf):
    t = tables(spark, sf)
    return to_map_item(filtered_snapshots(latest_of(t), t.aircraft))


def _frames_sql(src: str, max_gap: int, max_km: float) -> str:
    hv = ("2 * 6371.0 * atan2(sqrt(sin(radians(lat - start_lat) / 2) ** 2 + cos(radians(start_lat)) * cos(radians(lat))"
          " * sin(radians(lon - start_lon) / 2) ** 2), sqrt(1 - (sin(radians(lat - start_lat) / 2) ** 2"
          " + cos(radians(start_lat)) * cos(radians(lat)) * sin(radians(lon - start_lon) / 2) ** 2)))")
    ok = (f"coalesce(start_lat is not null and start_lon is not null and lat is not null and lon is not null"
          f" and (start_last_seen is null or last_seen is null or (last_seen - start_last_seen >= 0"
          f" and abs(last_seen - start_last_seen) <= {max_gap})) and {hv} <= {max_km}, false)")
    lin = lambda a, b: f"case when {a} is null or {b} is null then {b} else {a} + ({b} - {a}) * (frame / 4.0) end"
    hd = ("case when start_heading is null or heading is null then heading else ((((start_heading + "
          "((((heading - start_heading + 540.0) % 360.0) - 180.0)) * (frame / 4.0)) % 360.0) + 360.0) % 360.0) end")
    return f"""
fr AS (select *, {ok} as interpolable from {src}, (select range as frame from range(5)))
select icao24, frame, frame / 4.0 as progress, interpolable,
  {_r6(f"case when interpolable then {lin('start_lat', 'lat')} else lat end")} as frame_lat,
  {_r6(f"case when interpolable then {lin('start_lon', 'lon')} else lon end")} as frame_lon,
  {_r6(f"case when interpolable then {hd} else heading end")} as frame_heading,
  {_r6(f"case when interpolable then {lin('start_speed', 'speed')} else speed end")} as frame_speed,
  {_r6(f"case when interpolable then {lin('start_altitude', 'altitude')} else altitude end")} as frame_altitude
from fr"""


def _round_frames(df):
    r6 = lambda c: (F.floor(F.col(c) * 1000000.0 + 0.5) / 1000000.0).alias(c)
    return df.select("icao24", F.col("frame").cast("bigint").alias("frame"), "progress", "interpolable",
                     *[r6(c) for c in ("frame_lat", "frame_lon", "frame_heading", "frame_speed", "frame_altitude")])


@register("q7_motion_frames", _ITEMS + ", starts AS (select *, " + ", ".join(
    f"case when use then coalesce(prev_{c}, {c}) else {c} end as start_{c}"
    for c in ["lat", "lon", "heading", "speed", "altitude", "last_seen"]) + " from st)," + _frames_sql(
    "starts", 180, 200.0)[1:])
def q7_motion_frames(spark, sf):
    return _round_frames(motion_plan(_items(spark, sf), steps=4))


@register("w7_interpolate_pairs", _POS + """,
pairs AS (select icao24, lat, lon, heading, velocity as speed, coalesce(geo_altitude, baro_altitude) as altitude,
   last_contact as last_seen,
   lag(lat) over w as start_lat, lag(lon) over w as start_lon, lag(heading) over w as start_heading,
   lag(velocity) over w as start_speed, lag(coalesce(geo_altitude, baro_altitude)) over w as start_altitude,
   lag(last_contact) over w as start_last_seen, event_id
   from positions where icao24 is not null
   window w as (partition by icao24 order by last_contact asc nulls first, batch_epoch asc nulls first, event_id asc)),""" +
          _frames_sql("pairs", 21600, 2000.0)[1:].replace("select icao24, frame,", "select icao24, event_id, frame,"))
def w7_interpolate_pairs(spark, sf):
    p = tables(spark, sf).positions.where(F.col("icao24").isNotNull())
    wp = with_previous(p)
    pairs = wp.select("icao24", "event_id", "lat", "lon", "heading", F.col("velocity").alias("speed"),
                      X.altitude().alias("altitude"), F.col("last_contact").alias("last_seen"),
                      F.col("prev_lat").alias("start_lat"), F.col("prev_lon").alias("start_lon"),
                      F.col("prev_heading").alias("start_heading"), F.col("prev_velocity").alias("start_speed"),
                      F.col("prev_altitude").alias("start_altitude"),
                      F.col("prev_last_contact").alias("start_last_seen"))
    fr = interpolate_positions(pairs, 4, max_gap=21600, max_km=2000.0)
    return _round_frames_with_id(pairs, fr)


def _round_frames_with_id(pairs, fr):
    r6 = lambda c: (F.floor(F.col(c) * 1000000.0 + 0.5) / 1000000.0).alias(c)
    return fr.select("icao24", "event_id", F.col("frame").cast("bigint").alias("frame"), "progress", "interpolable",
                     *[r6(c) for c in ("frame_lat", "frame_lon", "frame_heading", "frame_speed", "frame_altitude")])


@register("a16_median_batch_gap", _ITEMS + """,
u AS (select * from st where use),
d AS (select case when last_seen - prev_last_seen > 0 then last_seen - prev_last_seen end as delta from u)
select (select count(*) from u) as usable_rows, (select quantile_cont(delta, 0.5) from d) as median_gap_s,
  case when (select count(*) from u) > 0 then least(20000.0, greatest(1000.0,
    coalesce((select quantile_cont(delta, 0.5) from d) * 1000.0, 10000.0))) end as duration_ms""")
def a16_median_batch_gap(spark, sf):
    return median_batch_gap(_items(spark, sf))


@register("a17_feed_freshness", _ITEMS + f"""
select max(last_seen) as newest_last_seen, {_NOW} - max(last_seen) as age_seconds,
  case when max(last_seen) is null then 'unknown' when {_NOW} - max(last_seen) <= 120 then 'online'
       else 'stale' end as status from items""")
def a17_feed_freshness(spark, sf):
    t = tables(spark, sf)
    return feed_freshness(_items(spark, sf), now_epoch(t.positions))


# ---------------------------------------------------------------- quota (Q8)
from skyfold.operators import quota as Qt  # noqa: E402

_FL = duck_ctes("fetch_log")
_W10_CTE = _FL + """,
ok AS (select * from fetch_log where not coalesce(failed, false)),
lk AS (select *, last_value(remaining ignore nulls) over (partition by source_id order by ts, seq
          rows between unbounded preceding and 1 preceding) as last_known_remaining from ok),
rs AS (select *, coalesce(remaining is not null and last_known_remaining is not null
          and remaining > last_known_remaining, false) as is_reset from lk),
pr AS (select *, cast(sum(case when is_reset then 1 else 0 end) over (partition by source_id order by ts, seq
          rows between unbounded preceding and current row) as bigint) as period from rs),
cc AS (select *, case when is_reset then 0 else 1 end as _req,
          case when is_reset then 0 else coalesce(states_count, 0) end as _ev,
          case when remaining is not null and last_known_remaining is not null and not is_reset
               and last_known_remaining > remaining then last_known_remaining - remaining else 0 end as _cr from pr),
w10 AS (select * exclude (_req, _ev, _cr),
          cast(sum(_req) over w as bigint) as requests_since_reset, cast(sum(_ev) over w as bigint) as events_since_reset,
          cast(sum(_cr) over w as bigint) as credits_since_reset
        from cc window w as (partition by source_id, period order by ts, seq
          rows between unbounded preceding and current row))
"""
_W10_COLS = ["source_id", "ts", "seq", "remaining", "last_known_remaining", "is_reset", "period",
             "requests_since_reset", "events_since_reset", "credits_since_reset"]


@register("w10_credit_periods", _W10_CTE + f"select {', '.join(_W10_COLS)} from w10")
def w10_credit_periods(spark, sf):
    return Qt.credit_periods(tables(spark, sf).fetch_log).select(*_W10_COLS)


def _lvl_sql(x: str) -> str:
    return (f"case when {x} >= 95.0 then 'WARN_95' when {x} >= 80.0 then 'WARN_80' "
            f"when {x} >= 50.0 then 'WARN_50' else 'NORMAL' end")


@register("w11_quota_levels", _W10_CTE + f""",
q0 AS (select *, cast(case when credit_limit > 0 then credit_limit else 4000 end as double) as q from w10),
q1 AS (select *, case when remaining is not null then least(100.0, greatest(0.0, (q - remaining) / q * 100.0)) end
          as consumed_pct from q0),
q2 AS (select *, case when remaining is not null then {_lvl_sql('consumed_pct')} end as lvl from q1),
q3 AS (select *, coalesce(lvl, last_value(lvl ignore nulls) over (partition by source_id order by ts, seq
          rows between unbounded preceding and 1 preceding), 'NORMAL') as level,
          coalesce(remaining, last_known_remaining) as known from q2)
select source_id, ts, seq, {_r6('consumed_pct')} as consumed_pct, level,
  case level when 'WARN_95' then 300000 when 'WARN_80' then 30000 else 10000 end as delay_ms,
  {_r6('case when known is null then 0.0 else least(100.0, greatest(0.0, greatest(0.0, q - known) / q * 100.0)) end')}
      as consumed_gauge_pct,
  {_r6('case when requests_since_reset = 0 then 0.0 else credits_since_reset / requests_since_reset end')}
      as avg_credits_per_request,
  {_r6('case when requests_since_reset = 0 then 0.0 else events_since_reset / requests_since_reset end')}
      as avg_events_per_request
from q3""")
def w11_quota_levels(spark, sf):
    d = Qt.quota_levels(Qt.credit_periods(tables(spark, sf).fetch_log))
    r6 = lambda c: (F.floor(F.col(c) * 1000000.0 + 0.5) / 1000000.0).alias(c)
    return d.select("source_id", "ts", "seq", r6("consumed_pct"), "level", "delay_ms", r6("consumed_gauge_pct"),
                    r6("avg_credits_per_request"), r6("avg_events_per_request"))


@register("w12_failure_streaks", _FL + f""",
f0 AS (select *, case when coalesce(failed, false) then 1 else 0 end as f from fetch_log),
f1 AS (select *, sum(1 - f) over (partition by source_id order by ts, seq
         rows between unbounded preceding and current row) as island from f0),
f2 AS (select *, sum(f) over (partition by source_id, island order by ts, seq
         rows between unbounded preceding and current row) as n from f1)
select source_id, ts, seq, cast(case when f = 1 then n else 0 end as bigint) as consecutive_failures,
  cast(case when f = 1 and n <= 10 then {Qt.FAILURE_BACKOFF_SECONDS}[cast(n as bigint)] end as bigint) as backoff_seconds,
  f = 1 and n > 10 as disabled,
  cast(case when f = 1 then {Qt.TOKEN_BACKOFF_SECONDS}[cast(least(n, 6) as bigint)] end as bigint) as token_cooldown_seconds
from f2""")
def w12_failure_streaks(spark, sf):
    return Qt.failure_streaks(tables(spark, sf).fetch_log).select(
        "source_id", "ts", "seq", "consecutive_failures", "backoff_seconds", "disabled", "token_cooldown_seconds")


@register("a21_http_outcomes", _FL + """
select case when coalesce(failed, false) then 'exception' when status = 429 then 'rate_limited'
            when status >= 500 then 'server_error' when status >= 400 then 'client_error' else 'success' end
         as outcome, count(*) as requests,
       floor(avg(duration_ms) * 1000.0 + 0.5) / 1000.0 as avg_duration_ms, max(duration_ms) as max_duration_ms
from fetch_log group by 1""")
def a21_http_outcomes(spark, sf):
    return Qt.http_outcomes(tables(spark, sf).fetch_log)


@register("s6_parse_fetch_headers", _FL + """
select source_id, seq,
  case when seq % 23 = 0 then null else remaining end as remaining,
  case when seq % 31 = 0 then null else credit_limit end as credit_limit,
  case when r > 0 and r < 1000000000 then ts + r when r < ts - 86400 or r > ts + 604800 then null
       else r end as reset_at
from (select *, case seq % 4 when 0 then 3600 + seq % 100 when 1 then ts + 86400 when 2 then ts - 259200 end as r
      from fetch_log)""")
def s6_parse_fetch_headers(spark, sf):
    fl = tables(spark, sf).fetch_log
    seq = F.col("seq")
    raw = fl.select(
        "source_id", "seq", F.col("ts").alias("fetched_at"),
        F.when(seq % 23 == 0, F.lit("n/a")).otherwise(F.col("remaining").cast("string")).alias("remaining_raw"),
        F.when(seq % 31 == 0, F.lit("4.0e2")).otherwise(F.col("credit_limit").cast("string")).alias("limit_raw"),
        F.when(seq % 4 == 0, (F.lit(3600) + seq % 100).cast("string"))
        .when(seq % 4 == 1, (F.col("ts") + 86400).cast("string"))
        .when(seq % 4 == 2, (F.col("ts") - 3 * 86400).cast("string")).otherwise(F.lit("soon")).alias("reset_raw"))
    return Qt.parse_fetch_headers(raw).select("source_id", "seq", "remaining", "credit_limit", "reset_at")


_MS = duck_ctes("metric_samples")
_MS_NOW = "(select max(ts) from metric_samples)"


def _increase_sql(range_s: int, metric_filter: str = "true") -> str:
    return f"""
inr AS (select * from metric_samples where ts > {_MS_NOW} - {range_s} and ts <= {_MS_NOW} and {metric_filter}),
dl AS (select *, lag(value) over (partition by metric, instance order by ts, seq) as pv from inr),
inc AS (select metric, instance, sum(case when pv is null then 0.0 when value < pv then value
          else value - pv end) as increase from dl group by 1, 2)"""


@register("w13_counter_increase", _MS + "," + _increase_sql(86400) + f"""
select metric, instance, {_r6('increase')} as increase from inc""")
def w13_counter_increase(spark, sf):
    s = tables(spark, sf).metric_samples
    now = int(s.agg(F.max("ts")).first()[0])
    return Qt.counter_increase(s, now).select(
        "metric", "instance", (F.floor(F.col("increase") * 1000000.0 + 0.5) / 1000000.0).alias("increase"))


@register("w13_credits_per_request_24h", _MS + "," + _increase_sql(86400) + """
select c.instance, floor(greatest(c.increase, 0.0) / greatest(r.increase, 1.0) * 100.0 + 0.5) / 100.0
  as credits_per_request_24h
from inc c join inc r on c.instance = r.instance
where c.metric = 'ingester_opensky_credits_used_since_reset' and r.metric = 'ingester_opensky_requests_since_reset'""")
def w13_credits_per_request_24h(spark, sf):
    s = tables(spark, sf).metric_samples
    return Qt.credits_per_request(s, int(s.agg(F.max("ts")).first()[0]))


_RQ = duck_ctes("requests")


@register("w15_fixed_window_contact", _RQ + """
select client, seq, ts, (ts // 900) * 900 as window_start,
  row_number() over (partition by sha256(client), (ts // 900) order by ts, seq) as n_in_window,
  row_number() over (partition by sha256(client), (ts // 900) order by ts, seq) <= 3 as accepted
from requests""")
def w15_fixed_window_contact(spark, sf):
    return Qt.fixed_window_quota(tables(spark, sf).requests, 900, 3, hash_key=True)


@register("w15_global_per_second", _RQ + """
select 'global' as client, seq, ts, ts as window_start,
  row_number() over (partition by ts order by seq) as n_in_window,
  row_number() over (partition by ts order by seq) <= 2 as accepted
from requests""")
def w15_global_per_second(spark, sf):
    r = tables(spark, sf).requests.select(F.lit("global").alias("client"), "seq", "ts")
    return Qt.fixed_window_quota(r, 1, 2)


@register("w16_sliding_quota", duck_ctes("requests").replace("WITH ", "WITH RECURSIVE ", 1) + """,
o AS (select client, seq, ts, row_number() over (partition by client order by ts, seq) as r from requests),
w(client, r, seq, ts, accepted, older, newer) AS (
  select client, r, seq, ts, true, null::bigint, ts from o where r = 1
  union all
  select o.client, o.r, o.seq, o.ts, w.older is null or w.older < o.ts - 3600,
         case when w.older is null or w.older < o.ts - 3600 then w.newer else w.older end,
         case when w.older is null or w.older < o.ts - 3600 then o.ts else w.newer end
  from w join o on o.client = w.client and o.r = w.r + 1)
select client, seq, ts, accepted from w""")
def w16_sliding_quota(spark, sf):
    """Order-dependent acceptance: at most two accepted requests an hour."""
    return Qt.sliding_quota(tables(spark, sf).requests, window=3600, max_requests=2)


# ---------------------------------------------------------------- observability
from skyfold.operators import observability as Ob  # noqa: E402

_FLOW = duck_ctes("flow_logs") + """,
fp AS (select ts, string_split(message, ' ') as f from flow_logs),
flows AS (select ts, cast(f[1] as int) as version, f[2] as account_id, f[3] as interface_id, f[4] as srcaddr,
            f[5] as dstaddr, cast(f[6] as int) as srcport, cast(f[7] as int) as dstport, cast(f[8] as int) as protocol,
            cast(f[9] as bigint) as packets, cast(f[10] as bigint) as bytes, cast(f[11] as bigint) as "start",
            cast(f[12] as bigint) as "end", f[13] as action, f[14] as log_status from fp where f[14] = 'OK')
"""


def _flows(spark, sf):
    return Ob.read_flow_logs(tables(spark, sf).flow_logs)


@register("s7_flow_logs", _FLOW + "select * from flows")
def s7_flow_logs(spark, sf):
    return _flows(spark, sf)


@register("a18_flows_by_action", _FLOW + """
select (ts // 300) * 300 as bin_start, action, count(*) as flows from flows group by 1, 2""")
def a18_flows_by_action(spark, sf):
    return Ob.flows_by_action(_flows(spark, sf))


@register("a19_top_rejects_by_srcaddr", _FLOW + """
select srcaddr, count(*) as rejects from flows where action = 'REJECT' group by 1
order by rejects desc, srcaddr asc limit 15""")
def a19_top_rejects_by_srcaddr(spark, sf):
    return Ob.top_rejects(_flows(spark, sf), "srcaddr")


@register("a19_top_rejects_by_dstport", _FLOW + """
select dstport, count(*) as rejects from flows where action = 'REJECT' group by 1
order by rejects desc, dstport asc limit 15""")
def a19_top_rejects_by_dstport(spark, sf):
    return Ob.top_rejects(_flows(spark, sf), "dstport")


@register("a20_metric_statistics", _MS + f"""
select metric, instance, (ts // 3600) * 3600 as period_start, {_r6('avg(value)')} as average,
  max(value) as maximum, {_r6('sum(value)')} as sum, count(*) as sample_count
from metric_samples group by 1, 2, 3""")
def a20_metric_statistics(spark, sf):
    d = Ob.metric_statistics(tables(spark, sf).metric_samples, 3600)
    r6 = lambda c: (F.floor(F.col(c) * 1000000.0 + 0.5) / 1000000.0).alias(c)
    return d.select("metric", "instance", "period_start", r6("average"), "maximum", r6("sum"), "sample_count")


@register("a22_rate_sum_by_instance", _MS + "," + _increase_sql(21600, "metric = 'ingester_opensky_requests_since_reset'")
          + f"""
select instance, {_r6('sum(increase / 21600.0)')} as rate from inc group by 1""")
def a22_rate_sum_by_instance(spark, sf):
    s = tables(spark, sf).metric_samples
    d = Ob.rate_sum_by(s, "ingester_opensky_requests_since_reset", int(s.agg(F.max("ts")).first()[0]),
                       range_seconds=21600)
    return d.select("instance", (F.floor(F.col("rate") * 1000000.0 + 0.5) / 1000000.0).alias("rate"))


@register("w14_sustained_alerts", duck_ctes("alert_samples") + """,
rules AS (select * from (values
  ('CriticalTargetDown', 'up', null, 600), ('ProcessorStalled', 'processor_last_processed_epoch', null, 300),
  ('RedisQueueBacklogHigh', 'processor_queue_depth', null, 600),
  ('IngesterBackoffActive', 'ingester_opensky_backoff_seconds', null, 600),
  ('IngesterDisabled', 'ingester_opensky_disabled', null, 120),
  ('OpenSkyRateLimited', 'ingester_opensky_states_http_requests_total', 'rate_limited', 600)) t(rule, m, o, due)),
s AS (select *, lag(value) over w as pv, lag(ts) over w as pt from alert_samples
      window w as (partition by metric, instance, outcome order by ts, seq)),
g AS (select s.*, rule, due, unnest(range(((ts + 59) // 60) * 60, ts + 300, 60)) as tick
      from s join rules on metric = m and (o is null or o = outcome)),
per AS (select rule, due, tick, instance, max_by(value, ts) as last, avg(value) as mean,
        sum(case when pt > tick - 300 then case when value < pv then value else value - pv end else 0 end) as inc
        from g group by all),
v AS (select rule, due, tick, case when rule = 'CriticalTargetDown' then instance else '' end as series,
        max(last) as top, max(mean) as mean, sum(inc) as inc from per group by all),
c AS (select rule, due, series, tick from v where case rule
        when 'CriticalTargetDown' then mean < 1 when 'ProcessorStalled' then tick - top > 600
        when 'RedisQueueBacklogHigh' then top > 500 when 'OpenSkyRateLimited' then inc > 0 else top > 0 end),
i AS (select *, tick - 60 * row_number() over (partition by rule, series order by tick) as island from c)
select rule, series, min(tick) as start_ts, max(tick) as end_ts, max(tick) - min(tick) as duration_s, count(*) as evaluations,
       max(tick) - min(tick) >= max(due) as fired
from i group by rule, series, island""")
def w14_sustained_alerts(spark, sf):
    """Six rules over scrapes with spells that fire, spells too short, and gaps."""
    return Ob.sustained_alerts(tables(spark, sf).alert_samples)


@register("w18_period_alarms", _MS + """,
per AS (select metric, instance, (ts // 3600) * 3600 as period_start, max(value) as maximum
        from metric_samples group by 1, 2, 3),
br AS (select * from per where maximum >= 40.0)
select b.metric, b.instance, b.period_start from br b join br p
  on b.metric = p.metric and b.instance = p.instance and p.period_start = b.period_start - 3600""")
def w18_period_alarms(spark, sf):
    """Every metric's series against one threshold."""
    return Ob.period_alarms(tables(spark, sf).metric_samples, 40.0, period=3600, n=2)


# ---------------------------------------------------------------- reference build (Q4)
from skyfold.sources import reference_data as R  # noqa: E402

_CSV_EXPECTED = """
csvn AS (select lower(printf('%06x', c_custkey - case when c_custkey % 7 = 0 then 1 else 0 end)) as icao24,
    'N' || cast(c_nationkey as varchar) as country,
    case c_mktsegment when 'AUTOMOBILE' then 'Heavy, multi-engine' when 'BUILDING' then 'O''Brien light'
         when 'FURNITURE' then 'H2T' end as category_description,
    case when c_custkey % 3 = 0 then 'L2J' end as icao_aircraft_class,
    'M' || cast(c_custkey % 13 as varchar) as manufacturer_icao,
    case when c_custkey % 4 <> 0 then 'Maker ' || cast(c_custkey % 13 as varchar) end as manufacturer_name,
    c_name as model,
    case when c_custkey % 6 <> 0 then 'F-' || lpad(cast(c_custkey as varchar), 5, '0') end as registration,
    case c_custkey % 5 when 0 then 'A320' when 1 then 'B744' when 3 then 'C172' when 4 then 'C172' end as typecode,
    c_custkey as ord, c_custkey % 50 = 0 as skipped
  from customer),
csvr AS (select * exclude (r) from (select *, row_number() over (partition by icao24 order by ord desc) as r
         from csvn where not skipped) where r = 1),
supn AS (select p_partkey as ord,
    case when p_partkey % 97 = 0 or p_partkey % 89 = 0 then 'bad_json' when p_partkey % 83 = 0 then 'bad_icao'
         else 'ok' end as status,
    lower(printf('%06x', p_partkey % 1800)) as icao,
    case when p_partkey % 3 = 0 then 'N' || cast(p_partkey as varchar) end as reg,
    'T' || cast(p_partkey % 17 as varchar) as icaotype, 'L1P' as short_type, p_brand as manufacturer,
    p_type as model,
    case p_partkey % 6 when 0 then 1 when 1 then 1 when 2 then 1 when 3 then 0 when 4 then 0 end as mil,
    case p_partkey % 5 when 0 then 1950 + p_partkey % 70 when 1 then 1990 + p_partkey % 30 end as year,
    case when p_partkey % 4 = 0 then 'Private ' || cast(p_partkey as varchar) end as ownop
  from part),
supr AS (select * exclude (r) from (select *, row_number() over (partition by icao order by ord desc) as r
         from supn where status = 'ok') where r = 1),
merged AS (select coalesce(a.icao24, b.icao) as icao24, a.country, a.category_description,
    coalesce(a.icao_aircraft_class, b.short_type) as icao_aircraft_class, a.manufacturer_icao,
    coalesce(a.manufacturer_name, b.manufacturer) as manufacturer_name, coalesce(a.model, b.model) as model,
    coalesce(a.registration, b.reg) as registration, coalesce(a.typecode, b.icaotype) as typecode,
    case when b.mil is not null then b.mil = 1 end as military_hint, cast(b.year as integer) as year_built,
    b.ownop as owner_operator, a.icao24 is not null as in_csv, b.icao is not null as in_sup
  from csvr a full join supr b on a.icao24 = b.icao)
"""


def _reference(spark, sf, keep=False):
    t = tables(spark, sf)
    csv = R.parse_aircraft_csv_lines(t.aircraft_csv_lines)
    return R.build_aircraft_reference(csv, t.supplement_lines, keep=keep)


@register("q4_aircraft_reference", "WITH " + _CSV_EXPECTED + """
select * exclude (in_csv, in_sup) from merged""")
def q4_aircraft_reference(spark, sf):
    return _reference(spark, sf)[0]


@register("a14_merge_stats", "WITH " + _CSV_EXPECTED + """
select (select count(*) from csvn where not skipped) as csv_imported,
       (select count(*) from csvn where skipped) as csv_skipped,
       (select count(*) from supn where status = 'ok') as basic_imported,
       (select count(*) from supn where status = 'bad_json') as basic_skipped_json,
       (select count(*) from supn where status = 'bad_icao') as basic_skipped_icao,
       (select count(*) from merged where in_csv) as rows_before,
       (select count(*) from merged where in_csv and in_sup) as overlap_before,
       (select count(*) from merged) as rows_after,
       (select count(*) from merged where coalesce(military_hint, false)) as military_true_total,
       (select count(*) from merged) - (select count(*) from merged where in_csv) as rows_added""")
def a14_merge_stats(spark, sf):
    return _reference(spark, sf)[1]


@register("s4_supplement_records", "WITH " + _CSV_EXPECTED + """
select ord as line_no, status, case when status = 'ok' then icao end as icao,
  case when status <> 'bad_json' then reg end as reg, case when status <> 'bad_json' then mil end as mil,
  cast(case when status <> 'bad_json' then year end as integer) as year from supn""")
def s4_supplement_records(spark, sf):
    s = R.parse_supplement(tables(spark, sf).supplement_lines)
    return s.select(F.col("_order").alias("line_no"), F.col("_status").alias("status"),
                    F.when(F.col("_status") == "ok", F.col("icao")).alias("icao"), "reg", "mil", "year")


@register("j5_overlap_count", "WITH " + _CSV_EXPECTED + """
select count(*) as overlap from csvr a where exists (select 1 from supr b where b.icao = a.icao24)""")
def j5_overlap_count(spark, sf):
    t = tables(spark, sf)
    csv = R.last_row_per_key(R.normalise_csv(R.parse_aircraft_csv_lines(t.aircraft_csv_lines))
                             .where(~F.col("_skipped")).drop("_skipped"), "icao24")
    sup = R.parse_supplement(t.supplement_lines)
    sup = R.last_row_per_key(sup.where(F.col("_status") == "ok").drop("_status"), "icao")
    return csv.join(sup, csv.icao24 == sup.icao, "left_semi").agg(F.count(F.lit(1)).alias("overlap"))


# ---------------------------------------------------------------- sources, photos, detail
from skyfold.operators.enrich import fresh_photos, resolve_photo  # noqa: E402
from skyfold.operators.photos import TRUSTED_HOSTS, as_photo_struct, parse_photo_payloads  # noqa: E402
from skyfold.plans.flights import flight_details  # noqa: E402
from skyfold.sources import readers as Rd  # noqa: E402


@register("s1_state_responses", _POS + """
select icao24, callsign, lat, lon, velocity, heading, geo_altitude, baro_altitude, on_ground, time_position,
       last_contact, batch_epoch from positions where event_id % 211 <> 0 and event_id % 101 <> 0""")
def s1_state_responses(spark, sf):
    states, _ = Rd.read_state_responses(tables(spark, sf).state_responses)
    return Rd.to_events(states).drop("vertical_rate", "ingested_at")


@register("s1_state_errors", _POS + "select count(*) as error_rows from positions where event_id % 211 = 0")
def s1_state_errors(spark, sf):
    _, errors = Rd.read_state_responses(tables(spark, sf).state_responses)
    return errors.agg(F.count(F.lit(1)).alias("error_rows"))


def _wire(spark, sf):
    return Rd.route_events(Rd.read_position_events(tables(spark, sf).wire_payloads))


# payloads of the fixture that are dead letters: not JSON, blank keys (spaces, a tab), a field of the wrong type
_DEAD = "(event_id % 97 = 0 or event_id % 89 = 0 or event_id % 83 = 0 or event_id % 79 = 0)"


@register("f7_split_valid_events", _POS + f"""
select event_id, case when {_DEAD} then 'dead_letter' else 'valid' end as route from positions""")
def f7_split_valid_events(spark, sf):
    return _wire(spark, sf).select("event_id", F.when(F.col("_route") == "ok", "valid").otherwise("dead_letter").alias("route"))


@register("s2_position_events", _POS + f"""
select event_id, icao24, callsign, lat, lon, velocity, heading, geo_altitude, baro_altitude, on_ground,
       time_position, last_contact, batch_epoch, '2024-01-01T00:00:00Z' as ingested_at
from positions where not {_DEAD}""")
def s2_position_events(spark, sf):
    """Payloads with numeric strings, mixed-case and padded keys among the plain ones."""
    return _wire(spark, sf).where(F.col("_route") == "ok").drop("vertical_rate", "_corrupt", "_route")


@register("a15_pipeline_health", _POS + f""",
v AS (select * from positions where not {_DEAD}),
k AS (select icao24, inside, row_number() over (partition by icao24 order by {O.EVENT_ORDER_DESC}) as r
      from (select *, {O.bbox_sql()} as inside from v where lat is not null and lon is not null))
select (select count(*) from v) as processed,
       (select count(*) from positions where {_DEAD}) as errors,
       (select max(last_contact) from v) as last_processed_epoch,
       (select count(*) from k where r = 1 and inside) as members_inside""")
def a15_pipeline_health(spark, sf):
    return Rd.routed_health(_wire(spark, sf), Bbox.default())


_PH = duck_ctes("photo_payloads") + """,
pj AS (select *, case when http_status = 429 then 'rate_limited' when http_status = 404 then 'not_found'
                      when http_status < 200 or http_status >= 300 then 'error' end as http_st,
         nullif(trim(json_extract_string(body, '$.photos[0].thumbnail.src')), '') as tu,
         nullif(trim(json_extract_string(body, '$.photos[0].thumbnail_large.src')), '') as lu,
         nullif(trim(json_extract_string(body, '$.photos[0].link')), '') as ku
       from photo_payloads),
pk AS (select *,
    case when lower(regexp_extract(tu, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/:?#]+)', 1)) = 'https'
          and lower(regexp_extract(tu, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/:?#]+)', 2)) in ({hosts}) then tu end as t_ok,
    case when lower(regexp_extract(lu, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/:?#]+)', 1)) = 'https'
          and lower(regexp_extract(lu, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/:?#]+)', 2)) in ({hosts}) then lu end as l_ok,
    case when lower(regexp_extract(ku, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/:?#]+)', 1)) = 'https'
          and lower(regexp_extract(ku, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/:?#]+)', 2)) in ({hosts}) then ku end as k_ok
    from pj),
ps AS (select *, coalesce(http_st,
    case when json_type(body, '$.error') = 'VARCHAR' then 'error'
         when coalesce(json_array_length(body, '$.photos'), 0) = 0 then 'not_found'
         when t_ok is null or l_ok is null or k_ok is null then 'error' else 'available' end) as status from pk),
photos AS (select lookup_kind, lookup_key, http_status, fetched_at, status,
    case when status = 'available' then t_ok end as thumbnail_url,
    case when status = 'available' and json_type(body, '$.photos[0].thumbnail.size.width') in ('UBIGINT', 'BIGINT', 'DOUBLE')
         then cast(json_extract(body, '$.photos[0].thumbnail.size.width') as integer) end as thumbnail_width,
    case when status = 'available' and json_type(body, '$.photos[0].thumbnail.size.height') in ('UBIGINT', 'BIGINT', 'DOUBLE')
         then cast(json_extract(body, '$.photos[0].thumbnail.size.height') as integer) end as thumbnail_height,
    case when status = 'available' then l_ok end as large_thumbnail_url,
    case when status = 'available' and json_type(body, '$.photos[0].thumbnail_large.size.width') in ('UBIGINT', 'BIGINT', 'DOUBLE')
         then cast(json_extract(body, '$.photos[0].thumbnail_large.size.width') as integer) end as large_width,
    case when status = 'available' and json_type(body, '$.photos[0].thumbnail_large.size.height') in ('UBIGINT', 'BIGINT', 'DOUBLE')
         then cast(json_extract(body, '$.photos[0].thumbnail_large.size.height') as integer) end as large_height,
    case when status = 'available' then nullif(trim(json_extract_string(body, '$.photos[0].photographer')), '') end
         as photographer,
    case when status = 'available' then k_ok end as source_link
  from ps)
""".replace("{hosts}", ", ".join(f"'{h}'" for h in TRUSTED_HOSTS))


def _photos(spark, sf):
    return parse_photo_payloads(tables(spark, sf).photo_payloads)


@register("n18_photo_payloads", _PH + "select * exclude (fetched_at) from photos")
def n18_photo_payloads(spark, sf):
    return _photos(spark, sf).drop("fetched_at")


@register("j7_resolve_photo", _PH.replace("WITH ", "WITH ", 1).replace(
    "photo_payloads AS (", "aircraft AS (" + __import__("skyfold.sources.testdata", fromlist=["x"]).aircraft_sql(
        __import__("skyfold.sources.testdata", fromlist=["x"]).DUCK) + "),\nphoto_payloads AS (", 1) + """,
a AS (select lower(trim(icao24)) as icao24, case when length(upper(trim(registration))) > 0
        then upper(trim(registration)) end as reg_key from aircraft),
h AS (select lower(trim(lookup_key)) as icao24, status, thumbnail_url from photos where lookup_kind = 'hex'),
r AS (select upper(trim(lookup_key)) as reg_key, status, thumbnail_url from photos where lookup_kind = 'reg')
select h.icao24, a.reg_key,
  case when h.status = 'not_found' and a.reg_key is not null then 'reg' else 'hex' end as resolved_by,
  case when h.status = 'not_found' and a.reg_key is not null then r.status else h.status end as status,
  case when h.status = 'not_found' and a.reg_key is not null then r.thumbnail_url else h.thumbnail_url end
    as thumbnail_url
from h left join a on h.icao24 = a.icao24 left join r on a.reg_key = r.reg_key""")
def j7_resolve_photo(spark, sf):
    t = tables(spark, sf)
    p = as_photo_struct(_photos(spark, sf))
    res = resolve_photo(p.where(F.col("lookup_kind") == "hex"), p.where(F.col("lookup_kind") == "reg"), t.aircraft)
    return res.select("icao24", "reg_key", "resolved_by", F.col("photo.status").alias("status"),
                      F.col("photo.thumbnail_url").alias("thumbnail_url"))


@register("j8_fresh_photos", _PH + """,
t AS (select *, cast(case status when 'available' then 604800 when 'not_found' then 21600
        when 'rate_limited' then 5 else 120 end as bigint) as ttl_seconds from photos)
select lookup_kind, lookup_key, status, fetched_at, ttl_seconds from t
where fetched_at + ttl_seconds > (select max(fetched_at) from photos) - 3600""")
def j8_fresh_photos(spark, sf):
    p = _photos(spark, sf)
    now = int(p.agg(F.max("fetched_at")).first()[0]) - 3600
    return fresh_photos(p, now).select("lookup_kind", "lookup_key", "status", "fetched_at", "ttl_seconds")


@register("q2_flight_detail", _POS + ", " + O.LATEST_CTE + """
select l.icao24, nullif(trim(l.callsign), '') as callsign, a.registration,
  case when nullif(trim(a.manufacturer_name), '') is not null then a.manufacturer_name
       else a.manufacturer_icao end as manufacturer,
  a.model, upper(nullif(trim(a.typecode), '')) as typecode,
  case when nullif(trim(a.category_description), '') is not null then a.category_description
       when nullif(trim(a.icao_aircraft_class), '') is not null then a.icao_aircraft_class end as category,
  l.lat, l.lon, l.heading, coalesce(l.geo_altitude, l.baro_altitude) as altitude, l.velocity as speed,
  l.vertical_rate, l.last_contact as last_seen, l.on_ground, a.country, a.military_hint, a.year_built,
  a.owner_operator
from latest l left join aircraft a on l.icao24 = lower(trim(a.icao24))""")
def q2_flight_detail(spark, sf):
    t = tables(spark, sf)
    latest = build_latest(t.positions)
    return flight_details(latest, t.aircraft, t.positions, latest.select("icao24"), flat=True)


# ---------------------------------------------------------------- streaming
from skyfold.streaming import streams as St  # noqa: E402


def _events_stream(spark, sf):
    return St.read_table_stream(spark, sf, "events")


@register("t1_stream_dead_letters", ORACLES["f7_split_valid_events"])
def t1_stream_dead_letters(spark, sf):
    from skyfold.sources.testdata import SPARK, positions_sql, wire_payloads_sql
    ev = _events_stream(spark, sf)
    name = "skyfold_t1_events_" + __import__("uuid").uuid4().hex[:8]
    ev.createOrReplaceTempView(name)
    payloads = spark.sql(wire_payloads_sql(positions_sql(SPARK, name)))
    routed = Rd.route_events(Rd.read_position_events(payloads)).select(  # parsed once
        "event_id", F.when(F.col("_route") == "ok", "valid").otherwise("dead_letter").alias("route"))
    d = St.stream_dir(spark, "t1")
    St.run_available_now(St.upsert_log_sink(routed, d + "/out", d + "/ckpt", output_mode="append"))
    return spark.read.parquet(d + "/out").drop("batch_id")


from skyfold.sources.testdata import DUCK, positions_sql, stream_events_sql  # noqa: E402


def _arrivals(spark, sf):
    """The out-of-order stream fixture, a batch table with the micro-batch number ``mb``."""
    from skyfold.sources.testdata import SPARK, stream_events_sql
    t = tables(spark, sf)
    return spark.sql(stream_events_sql(SPARK, t._registered("events")))


def _run_batches(spark, sf, name, make_writer):
    """Land the fixture's micro-batches one after another in a shared folder
    and run the stream over each as it lands (one checkpoint for all runs).
    ``make_writer(positions, folder)`` gives the stream's writer."""
    from skyfold.sources.testdata import STREAM_BATCHES
    d = St.stream_dir(spark, name)
    arrivals = _arrivals(spark, sf)
    for mb in range(STREAM_BATCHES):
        arrivals.where(F.col("mb") == mb).drop("mb").write.parquet(f"{d}/in/mb{mb}")
        src = spark.readStream.schema(arrivals.drop("mb").schema).parquet(f"{d}/in/*")
        pos = St.positions_stream(src).where(F.col("icao24").isNotNull())
        St.run_available_now(make_writer(pos, d))
    return d


def _state_log(spark, sf):
    return _run_batches(spark, sf, "t2", lambda pos, d: St.upsert_log_sink(
        St.stream_latest(pos), d + "/out", d + "/ckpt")) + "/out"


# arrivals in the oracle: position rows with their micro-batch, and one number
# that orders the events of an aircraft (time, nulls first, then id)
_ARR = f"""WITH sev AS ({stream_events_sql(DUCK)}),
arr AS (select *, coalesce(last_contact, -1)::HUGEINT * 1000000000000 + event_id as k
        from ({positions_sql(DUCK, "sev", extra="mb")})),"""
_T2_SQL = _ARR + f"""
late AS (select *, max(k) over (partition by icao24 order by mb range between unbounded preceding and 1 preceding) as held
         from arr),
fin AS (select icao24, max(k) as top, max_by(mb, (k, mb)) as at from arr group by 1),
ranked AS (select a.*, row_number() over (partition by a.icao24 order by a.k desc) as r
           from arr a join fin f on a.icao24 = f.icao24 and a.mb <= f.at),
known AS (select icao24, max_by({O.bbox_sql()}, k) as inside from arr where lat is not null and lon is not null group by 1),
cnt AS (select icao24, count_if(k < held) as late_events, least(count(*), 180) as track_points from late group by 1)
select c.icao24, c.event_id, c.last_contact, c.batch_epoch, p.lat as prev_lat, p.lon as prev_lon, p.heading as prev_heading,
       p.velocity as prev_velocity, coalesce(p.geo_altitude, p.baro_altitude) as prev_altitude,
       p.last_contact as prev_last_contact, known.inside, cast(cnt.late_events as bigint) as late_events,
       cast(cnt.track_points as bigint) as track_points
from ranked c left join ranked p on c.icao24 = p.icao24 and p.r = 2
left join known on known.icao24 = c.icao24 join cnt on cnt.icao24 = c.icao24 where c.r = 1"""


@register("t2_stream_latest_state", _T2_SQL)
def t2_stream_latest_state(spark, sf):
    """Keyed state over out-of-order micro-batches with null times and replays."""
    return St.read_upsert_log(spark, _state_log(spark, sf), ["icao24"]).select(
        "icao24", "event_id", "last_contact", "batch_epoch", "prev_lat", "prev_lon", "prev_heading",
        "prev_velocity", "prev_altitude", "prev_last_contact", "inside", "late_events", "track_points")


@register("t3_stream_tracks", _ARR + """
r AS (select *, row_number() over (partition by icao24 order by k desc) as rank from arr)
select icao24, rank, event_id, last_contact, batch_epoch, lat, lon, coalesce(geo_altitude, baro_altitude) as altitude,
       on_ground from r where rank <= 180""")
def t3_stream_tracks(spark, sf):
    """The track table that the stream maintains: newest 180 points per aircraft."""
    return St.read_track_log(spark, _run_batches(spark, sf, "t3", lambda pos, d: St.track_log_writer(
        pos, d + "/out", d + "/ckpt")) + "/out")


@register("t4_stream_members", _ARR + f"""
known AS (select icao24, max_by({O.bbox_sql()}, k) as inside from arr where lat is not null and lon is not null group by 1)
select icao24 from known where inside""")
def t4_stream_members(spark, sf):
    """Aircraft whose newest known position is inside, however late other reports come."""
    return St.read_upsert_log(spark, _state_log(spark, sf), ["icao24"]).where("inside").select("icao24")


def _stream_activity_table(spark, sf):
    t = tables(spark, sf)
    pos = St.positions_stream(_events_stream(spark, sf)).where(F.col("icao24").isNotNull())
    d = St.stream_dir(spark, "t5")
    St.run_available_now(St.upsert_log_sink(St.stream_activity(St.enrich_stream(pos, t.aircraft)),
                                            d + "/out", d + "/ckpt"))
    return St.read_upsert_log(spark, d + "/out", ["bucket_epoch"]).drop("aircraft_sketch", "military_sketch")


@register("t5_stream_activity_counts", _EV_ENRICHED + """
select (last_contact // 60) * 60 as bucket_epoch, count(*) as events_total,
       cast(count_if(coalesce(military_hint, false)) as bigint) as events_military
from ev where last_contact is not null group by 1""")
def t5_stream_activity_counts(spark, sf):
    return _stream_activity_table(spark, sf).select("bucket_epoch", "events_total", "events_military")


@register("t5_stream_activity_sketch", _EV_ENRICHED + "select * from (" + _minutes_sql(60) + ")")
def t5_stream_activity_sketch(spark, sf):
    """Distinct aircraft per minute from the streamed sketches, which are exact
    at the counts of a minute here."""
    return _stream_activity_table(spark, sf)


@register("t6_stream_activity_series", ORACLES["q3_activity_series"])
def t6_stream_activity_series(spark, sf):
    """Display series re-aggregated from the minute table that the stream keeps."""
    from skyfold.operators.activity import activity_series
    minutes = _stream_activity_table(spark, sf)
    now = now_epoch(tables(spark, sf).positions)
    return activity_series(St.retained_buckets(minutes, now, 60, 7 * 86400), now, 86400, 48)


@register("t8_stream_batch_updates", _ARR + """
m AS (select mb, max(batch_epoch) as e from arr group by 1),
h AS (select e, max(e) over (order by mb rows between unbounded preceding and 1 preceding) as before from m)
select e as latest_batch_epoch from h where before is null or e > before""")
def t8_stream_batch_updates(spark, sf):
    """Every epoch emitted: the running maximum over all micro-batches, when it rises."""
    d = _run_batches(spark, sf, "t8", lambda pos, d: St.upsert_log_sink(
        St.stream_batch_updates(pos), d + "/out", d + "/ckpt"))
    return spark.read.parquet(d + "/out").select("latest_batch_epoch")


@register("t10_stream_events_by_attribute", ORACLES["a12_events_by_attribute"])
def t10_stream_events_by_attribute(spark, sf):
    t = tables(spark, sf)
    pos = St.positions_stream(_events_stream(spark, sf)).where(F.col("icao24").isNotNull())
    d = St.stream_dir(spark, "t10")
    St.run_available_now(St.attribute_counts_writer(St.enrich_stream(pos, t.aircraft), d + "/out", d + "/ckpt"))
    return (spark.read.parquet(d + "/out").groupBy("attribute", "value")
            .agg(F.sum("events").cast("long").alias("events")))


# ---------------------------------------------------------------- remaining families
from skyfold.operators.enrich import pair_batches  # noqa: E402


from skyfold.sources.testdata import aircraft_sql  # noqa: E402
from skyfold.streaming.read_model import ReadModel  # noqa: E402
from skyfold.streaming.routing import route_events, routed_sink  # noqa: E402

# the stream fixture's arrivals with aircraft data; ``before``: the newest time of earlier micro-batches
_ARR_EV = _ARR + f"""
aircraft AS ({aircraft_sql(DUCK)}),
tops AS (select mb, max(last_contact) as top from arr where icao24 is not null group by 1),
befores AS (select mb, max(top) over (order by mb rows between unbounded preceding and 1 preceding) as before from tops),
ev AS (select p.*, b.before, a.icao24 is not null as has_metadata, a.country, a.military_hint
       from arr p join befores b on b.mb = p.mb left join aircraft a on lower(trim(p.icao24)) = lower(trim(a.icao24))
       where p.icao24 is not null)"""


def _read_model(spark, sf, name):
    """The read model after the five out-of-order micro-batches of the stream fixture."""
    aircraft = tables(spark, sf).aircraft
    models = []

    def writer(pos, d):
        models.append(ReadModel(spark, d + "/model", max_deltas=2))
        return models[-1].writer(pos, aircraft, d + "/ckpt")

    _run_batches(spark, sf, name, writer)
    return models[-1]


@register("k2_read_model", _ARR_EV + f""",
known AS (select icao24, max_by({O.bbox_sql()}, k) as inside from ev where lat is not null and lon is not null group by 1)
select 'latest' as tbl, icao24 as key, max(last_contact) as n from ev group by icao24
union all select 'track', icao24, least(count(*), 180) from ev group by icao24
union all select 'member', icao24, 1 from known where inside
union all select 'activity', ((last_contact // 60) * 60)::varchar, count(*) from ev
          where last_contact is not null group by last_contact // 60
union all select 'country', case when has_metadata and nullif(trim(country), '') is not null
            then trim(country) else 'unknown' end as c, count(*) from ev group by c""")
def k2_read_model(spark, sf):
    """Contents of all tables of the read model, as (table, key, number), after
    five micro-batches with compactions between them."""
    model = _read_model(spark, sf, "k2")
    latest = model.latest()
    row = lambda df, tbl, key, n: df.select(
        F.lit(tbl).alias("tbl"), F.col(key).cast("string").alias("key"), F.expr(n).cast("long").alias("n"))
    return (row(latest, "latest", "icao24", "last_contact").unionByName(row(latest, "track", "icao24", "track_points"))
            .unionByName(row(latest.where("inside"), "member", "icao24", "1"))
            .unionByName(row(model.activity().where("bucket_epoch is not null"), "activity", "bucket_epoch", "events_total"))
            .unionByName(row(model.table("attributes").where("attribute = 'country'"), "country", "value", "events")))


@register("t5_activity_corrections", _ARR_EV + """
select (last_contact // 60) * 60 as bucket_epoch, count(*) as events_total,
       cast(count_if(coalesce(military_hint, false)) as bigint) as events_military,
       count(distinct icao24) as aircraft_total,
       count(distinct case when coalesce(military_hint, false) then icao24 end) as aircraft_military,
       cast(count_if(before is not null and (last_contact // 60) * 60 + 60 + 600 <= before) as bigint) as late_events
from ev group by 1""")
def t5_activity_corrections(spark, sf):
    """Minute buckets over out-of-order micro-batches: late reports correct closed
    buckets and are counted; reports without a time are the null bucket."""
    return _read_model(spark, sf, "t5c").activity().select(
        "bucket_epoch", "events_total", "events_military", "aircraft_total", "aircraft_military", "late_events")


@register("t7_bucket_expiry", _ARR_EV + """,
now AS (select max(last_contact) as now from ev),
b AS (select (last_contact // 60) * 60 as bucket_epoch, count(*) as events_total from ev
      where last_contact is not null group by 1)
select bucket_epoch, events_total, case when bucket_epoch + 604800 + 60 <= now then 'expired' else 'kept' end as state
from b, now""")
def t7_bucket_expiry(spark, sf):
    """What a clock step to the newest report expires with a retention of a week,
    and what the table still holds."""
    model = _read_model(spark, sf, "t7")
    gone = model.expire(model.current()["newest"], 7 * 86400)
    kept = model.activity().where("bucket_epoch is not null")
    return gone.select("bucket_epoch", "events_total", F.lit("expired").alias("state")).unionByName(
        kept.select("bucket_epoch", "events_total", F.lit("kept").alias("state")))


@register("t9_event_routes", _ARR_EV + """,
timed AS (select *, last_contact is null as no_time, coalesce(last_contact < before - 600, false) as late from ev),
nth AS (select *, row_number() over (partition by icao24, last_contact, no_time, late order by mb, event_id) as r from timed)
select icao24, event_id, last_contact,
       case when no_time then 'no_time' when late then 'late' when r > 1 then 'duplicate' else 'passed' end as route
from nth""")
def t9_event_routes(spark, sf):
    """Every report of five out-of-order micro-batches with its route, one
    watermark of 600 s deciding."""
    d = _run_batches(spark, sf, "t9r", lambda pos, d: routed_sink(route_events(pos, 600), d + "/out", d + "/ckpt"))
    return spark.read.parquet(d + "/out").select("icao24", "event_id", "last_contact", "route")


@register("t9_stream_dedup", _ARR + """
one AS (select 1)
select icao24, last_contact, count(*) as copies from arr
where icao24 is not null and last_contact is not null group by 1, 2""")
def t9_stream_dedup(spark, sf):
    """Each (icao24, last_contact) passes once over all micro-batches; ``copies``
    counts it in the source."""
    from skyfold.sources.testdata import SPARK, positions_sql
    d = _run_batches(spark, sf, "t9", lambda pos, d: St.upsert_log_sink(
        St.dedupe_events(pos, 60 * 86400).select("icao24", "last_contact"), d + "/out", d + "/ckpt", output_mode="append"))
    _arrivals(spark, sf).createOrReplaceTempView("skyfold_t9_arrivals")
    src = spark.sql(positions_sql(SPARK, "skyfold_t9_arrivals")).where(
        F.col("icao24").isNotNull() & F.col("last_contact").isNotNull()).groupBy("icao24", "last_contact").agg(
        F.count(F.lit(1)).alias("copies"))
    return spark.read.parquet(d + "/out").drop("batch_id").join(src, ["icao24", "last_contact"], "left")


@register("t9_late_rows", _ARR + """
h AS (select *, max(last_contact) over (partition by icao24 order by mb range between unbounded preceding and 1 preceding)
        as held from arr)
select icao24, event_id, last_contact, case when last_contact is null then 'no_time' else 'late' end as reason
from h where last_contact is null or last_contact < held - 3600""")
def t9_late_rows(spark, sf):
    """Side table of the rows that come more than an hour after a newer report, or carry no time."""
    d = _run_batches(spark, sf, "t9l", lambda pos, d: St.upsert_log_sink(
        St.late_rows(pos, 3600), d + "/out", d + "/ckpt", output_mode="append"))
    return spark.read.parquet(d + "/out").drop("batch_id")


@register("j6_pair_batches", _POS + """,
b AS (select distinct batch_epoch from positions where batch_epoch is not null order by batch_epoch desc limit 2),
snap AS (select * exclude (r) from (select *, row_number() over (partition by icao24, batch_epoch
          order by last_contact desc nulls last, event_id desc) as r from positions
          where batch_epoch in (select batch_epoch from b)) where r = 1),
cur AS (select * from snap where batch_epoch = (select max(batch_epoch) from b)),
prv AS (select * from snap where batch_epoch = (select min(batch_epoch) from b)
        and (select count(*) from b) = 2)
select c.icao24, c.last_contact, c.lat, c.lon, p.last_contact as start_last_contact, p.lat as start_lat,
       p.lon as start_lon from cur c left join prv p on c.icao24 = p.icao24""")
def j6_pair_batches(spark, sf):
    p = tables(spark, sf).positions
    # the two newest batches, at most two rows; without any batch there is no pair
    top = p.where(F.col("batch_epoch").isNotNull()).groupBy("batch_epoch").agg(F.lit(0).alias("_one")).orderBy(
        F.col("batch_epoch").desc()).limit(2)
    newest = F.max("batch_epoch").over(Window.partitionBy("_one"))
    rows = p.join(F.broadcast(top.select("batch_epoch", (F.col("batch_epoch") == newest).alias("_current"))), "batch_epoch")
    snap = rows.groupBy("icao24", "_current").agg(F.max_by(
        F.struct("last_contact", "lat", "lon"), F.struct("last_contact", "event_id")).alias("r")).select("icao24", "_current", "r.*")
    return pair_batches(snap.where(~F.col("_current")).drop("_current"), snap.where("_current").drop("_current")).select(
        "icao24", "last_contact", "lat", "lon", "start_last_contact", "start_lat", "start_lon")


@register("q1_list_flights_by_attributes", _Q1_BASE + f"""
, items AS (select {O.MAP_ITEM_SELECT}, category as _c, typecode as _t from snap
  where lower(nullif(trim(category), '')) = 'heavy' and upper(nullif(trim(typecode), '')) = 'B744')
select * exclude (_c, _t) from items order by altitude desc nulls last, icao24 desc limit 50""")
def q1_list_flights_by_attributes(spark, sf):
    t = tables(spark, sf)
    return list_flights(latest_of(t), t.aircraft, limit=50, sort="altitude", order="desc",
                        category=" Heavy ", typecode="b744")


@register("a21_http_duration_quantiles", duck_ctes("fetch_log") + """
select round(quantile_cont(duration_ms, 0.5), 6) as p50_ms, round(quantile_cont(duration_ms, 0.95), 6) as p95_ms,
       round(quantile_cont(duration_ms, 0.99), 6) as p99_ms from fetch_log""")
def a21_http_duration_quantiles(spark, sf):
    d = Qt.http_duration_quantiles(tables(spark, sf).fetch_log, exact=True)
    return d.select(*[F.round(c, 6).alias(c) for c in d.columns])


@register("q2_flight_detail_nested", f"""
WITH detail AS ({ORACLES["q2_flight_detail"]}), photo AS ({ORACLES["j7_resolve_photo"]}),
track AS ({_POS} select icao24, count(*) as track_points, max(last_contact) as track_newest,
            min(last_contact) as track_oldest
          from (select *, row_number() over (partition by icao24 order by {O.EVENT_ORDER_DESC}) as r from positions)
          where r <= 120 group by icao24)
select d.*, p.status as photo_status, p.thumbnail_url as photo_url, t.track_points, t.track_newest, t.track_oldest
from detail d left join photo p on p.icao24 = d.icao24 left join track t on t.icao24 = d.icao24""")
def q2_flight_detail_nested(spark, sf):
    """The full detail answer; the photo struct and the track array are flattened."""
    t = tables(spark, sf)
    latest = latest_of(t)
    p = as_photo_struct(_photos(spark, sf))
    photos = resolve_photo(p.where(F.col("lookup_kind") == "hex"), p.where(F.col("lookup_kind") == "reg"), t.aircraft)
    d = flight_details(latest, t.aircraft, t.positions, latest.select("icao24"), photos=photos)
    times = F.transform("track", lambda x: x["last_contact"])
    return d.select("*", F.col("photo.status").alias("photo_status"), F.col("photo.thumbnail_url").alias("photo_url"),
                    F.size("track").cast("long").alias("track_points"), F.array_max(times).alias("track_newest"),
                    F.array_min(times).alias("track_oldest")).drop("photo", "track")


@register("q8_fetch_quota_report", _W10_CTE + f""",
q0 AS (select *, cast(case when credit_limit > 0 then credit_limit else 4000 end as double) as q from w10),
q2 AS (select *, case when remaining is not null then {_lvl_sql('least(100.0, greatest(0.0, (q - remaining) / q * 100.0))')} end
          as lvl from q0),
q3 AS (select *, coalesce(lvl, last_value(lvl ignore nulls) over (partition by source_id order by ts, seq
          rows between unbounded preceding and 1 preceding), 'NORMAL') as level from q2),
lastrow AS (select source_id, level as last_level, credits_since_reset as last_credits_since_reset,
              requests_since_reset as last_requests_since_reset from (select *, row_number() over
              (partition by source_id order by ts desc, seq desc) as r from q3) where r = 1),
per AS (select source_id, cast(max(period) + 1 as bigint) as periods from w10 group by 1),
f0 AS (select *, case when coalesce(failed, false) then 1 else 0 end as f from fetch_log),
f1 AS (select *, sum(1 - f) over (partition by source_id order by ts, seq rows between unbounded preceding
         and current row) as island from f0),
f2 AS (select *, sum(f) over (partition by source_id, island order by ts, seq rows between unbounded preceding
         and current row) as n from f1),
st AS (select source_id, count(*) as requests, cast(sum(f) as bigint) as failures,
         cast(max(case when f = 1 then n else 0 end) as bigint) as max_consecutive_failures,
         cast(count_if(status = 429 and f = 0) as bigint) as rate_limited from f2 group by 1)
select st.*, per.periods, lastrow.last_level, lastrow.last_credits_since_reset, lastrow.last_requests_since_reset
from st join per using (source_id) join lastrow using (source_id)""")
def q8_fetch_quota_report(spark, sf):
    fl = tables(spark, sf).fetch_log
    lv = Qt.quota_levels(Qt.credit_periods(fl))
    last = lv.groupBy("source_id").agg(F.max_by(F.struct("level", "credits_since_reset", "requests_since_reset"),
                                                F.struct("ts", "seq")).alias("l"),
                                       (F.max("period") + 1).cast("long").alias("periods"))
    st = Qt.failure_streaks(fl).groupBy("source_id").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("failed").alias("failures"),
        F.max("consecutive_failures").alias("max_consecutive_failures"),
        F.count_if((F.col("status") == 429) & ~F.col("failed")).alias("rate_limited"))
    return st.join(last, "source_id").select(
        "source_id", "requests", "failures", "max_consecutive_failures", "rate_limited", "periods",
        F.col("l.level").alias("last_level"), F.col("l.credits_since_reset").alias("last_credits_since_reset"),
        F.col("l.requests_since_reset").alias("last_requests_since_reset"))


# ---------------------------------------------------------------- readers and writers, by round trip
from skyfold.operators import metrics as _MO  # noqa: E402
from skyfold.operators.filters import attr_filter  # noqa: E402
from skyfold.operators.motion import motion_answer  # noqa: E402


@register("k1_publish_events", _POS + """
select icao24, callsign, lat, lon, velocity, heading, geo_altitude, baro_altitude, on_ground, time_position, last_contact,
       batch_epoch, '2024-01-01T00:00:00Z' as ingested_at from positions where icao24 is not null""")
def k1_publish_events(spark, sf):
    """Published payloads, written as text to the shared folder and read again."""
    d = St.stream_dir(spark, "k1")
    Rd.publish_events(tables(spark, sf).positions.where("icao24 is not null"), "2024-01-01T00:00:00Z").write.text(d)
    valid, _ = Rd.split_events(Rd.read_position_events(spark.read.text(d)))
    return valid.drop("vertical_rate")


@register("k3_reference_artifact", ORACLES["q4_aircraft_reference"])
def k3_reference_artifact(spark, sf):
    """The reference table as a versioned artifact, loaded again."""
    table, stats = _reference(spark, sf, keep=True)
    target = R.write_aircraft_reference(table, stats, St.stream_dir(spark, "k3"), "1")
    return R.load_aircraft_reference(spark, target + "/aircraft").select(*table.columns)


@register("s8_metric_samples", _MS + "select metric, instance, ts, value from metric_samples")
def s8_metric_samples(spark, sf):
    """Samples written as JSON with a label map, read with the typed reader."""
    d = St.stream_dir(spark, "s8")
    tables(spark, sf).metric_samples.select(
        "metric", F.create_map(F.lit("instance"), F.col("instance")).alias("labels"),
        F.timestamp_seconds("ts").alias("ts"), "value").write.json(d)
    return Ob.read_metric_samples(spark, d, "json").select("metric", "instance", "ts", "value")


@register("t7_retained_buckets", _EV_ENRICHED + f"""
select bucket_epoch, events_total from ({_minutes_sql(3600)})
where bucket_epoch + 604800 + 3600 > (select max(last_contact) from positions)""")
def t7_retained_buckets(spark, sf):
    """Hourly buckets still kept at the newest report, with a retention of a week."""
    t = tables(spark, sf)
    b = activity_buckets(enrich_events(t.positions.where(F.col("icao24").isNotNull()), t.aircraft), 3600)
    return St.retained_buckets(b, now_epoch(t.positions), 3600, 7 * 86400).select("bucket_epoch", "events_total")


@register("f6_country_filter", _POS + "select icao24, country from aircraft where lower(trim(country)) = 'nation_3'")
def f6_country_filter(spark, sf):
    return attr_filter(tables(spark, sf).aircraft, "country", "  NATION_3 ", "lower").select("icao24", "country")


@register("q7_motion_answer", _ITEMS + f""",
gap AS (select median(last_seen - prev_last_seen) as g from st where use and last_seen > prev_last_seen),
n AS (select count(*) as n from st where use)
select icao24, case when use then coalesce(prev_lat, lat) else lat end as start_lat,
       case when use then coalesce(prev_lon, lon) else lon end as start_lon,
       cast(case when n.n > 0 then least({float(_MO.MOTION_MAX_MS)}, greatest({float(_MO.MOTION_MIN_MS)},
            coalesce(gap.g * 1000.0, {float(_MO.MOTION_FALLBACK_MS)}))) end as double) as duration_ms,
       coalesce(use and 2 * 6371.0 * asin(sqrt(sin(radians(lat - prev_lat) / 2) ** 2 + cos(radians(prev_lat))
            * cos(radians(lat)) * sin(radians(lon - prev_lon) / 2) ** 2)) <= 0.05, false) as is_static
from st, gap, n""")
def q7_motion_answer(spark, sf):
    """Start pose, duration and static flag of every map item."""
    return motion_answer(_items(spark, sf)).select("icao24", "start_lat", "start_lon", "duration_ms", "is_static")


# ---------------------------------------------------------------- sketches, chained windows, full answers
from skyfold.operators.activity import activity_series, sketch_estimates, unite_buckets, within_error  # noqa: E402
from skyfold.plans.flights import flight_detail  # noqa: E402
from skyfold.plans.metrics import metrics_answer  # noqa: E402
from skyfold.sources.sinks import write_tracks  # noqa: E402

_DISPLAY, _DELAY = 6 * 3600, 7 * 86400


@register("t6_stream_series_append", _ARR_EV + f""",
kept AS (select * from ev where last_contact is not null
         and (before is null or (last_contact // 60) * 60 + 60 > before - {_DELAY})),
top AS (select max(last_contact) - {_DELAY} as mark from ev)
select (last_contact // {_DISPLAY}) * {_DISPLAY} as bucket_start, count(*) as events_total,
       cast(count_if(coalesce(military_hint, false)) as bigint) as events_military,
       count(distinct icao24) as aircraft_total,
       count(distinct case when coalesce(military_hint, false) then icao24 end) as aircraft_military,
       count(distinct last_contact // 60) as minutes
from kept, top group by 1, mark having (last_contact // {_DISPLAY}) * {_DISPLAY} + {_DISPLAY} <= mark""")
def t6_stream_series_append(spark, sf):
    """Closed display buckets that the chained windows emitted over five out-of-order
    micro-batches, with a watermark of a week; what came later is not in them."""
    aircraft = tables(spark, sf).aircraft
    d = _run_batches(spark, sf, "t6a", lambda pos, d: St.upsert_log_sink(
        St.stream_activity_series(St.enrich_stream(pos, aircraft), _DISPLAY, 60, _DELAY),
        d + "/out", d + "/ckpt", output_mode="append"))
    return spark.read.parquet(d + "/out").drop("batch_id")


@register("a7_activity_sketches", _EV_ENRICHED + "select *, true as in_range from (" + _minutes_sql(3600) + ")")
def a7_activity_sketches(spark, sf):
    """Hourly sketch buckets beside the exact counts; ``in_range`` holds where both
    estimates are within four standard errors."""
    t = tables(spark, sf)
    ev = enrich_events(t.positions.where(F.col("icao24").isNotNull()), t.aircraft)
    est = sketch_estimates(activity_buckets(ev, 3600, mode="sketch")).select(
        "bucket_epoch", F.col("aircraft_total").alias("_a"), F.col("aircraft_military").alias("_m"))
    return activity_buckets(ev, 3600).join(est, "bucket_epoch").withColumn(
        "in_range", within_error("_a", "aircraft_total") & within_error("_m", "aircraft_military")).drop("_a", "_m")


@register("a8_series_united", _ARR_EV + f""",
positions AS ({positions_sql(DUCK, "events")}),
reports AS (select icao24, last_contact from positions where icao24 is not null
         union all select icao24, last_contact from ev),
p AS (select max(last_contact) as now, max(last_contact) - 604800 as start, cast(12600 as bigint) as width from positions),
m AS (select *, (last_contact // 60) * 60 as minute from reports where last_contact is not null),
agg AS (select least(47, case when minute < start then 0 else (minute - start) // width end) as idx,
               count(*) as events_total, count(distinct icao24) as aircraft_exact
        from m, p where minute >= (start // 60) * 60 and minute <= now group by 1)
select g.idx, p.start + g.idx * p.width as bucket_start, coalesce(a.events_total, 0) as events_total,
       coalesce(a.aircraft_exact, 0) as aircraft_exact, true as in_range
from (select range as idx from range(48)) g cross join p left join agg a on a.idx = g.idx""")
def a8_series_united(spark, sf):
    """A week's display series with true distinct aircraft: minute sketches of the batch
    history and of the stream's read model united, beside the exact counts."""
    t = tables(spark, sf)
    pos = t.positions.where(F.col("icao24").isNotNull())
    streamed = _read_model(spark, sf, "a8").activity()
    minutes = unite_buckets(activity_buckets(enrich_events(pos, t.aircraft), 60, mode="sketch"), streamed)
    now = now_epoch(t.positions)
    series = activity_series(minutes, now, 7 * 86400, 48, distinct="merge")
    start, width = now - 7 * 86400, 7 * 86400 // 48
    arrived = St.positions_stream(_arrivals(spark, sf)).where(F.col("icao24").isNotNull())
    minute = F.floor(F.col("last_contact") / 60) * 60
    exact = (pos.select("icao24", "last_contact").unionByName(arrived.select("icao24", "last_contact"))
             .where((minute >= start // 60 * 60) & (minute <= now))
             .groupBy(F.least(F.lit(47), F.greatest(F.lit(0), F.floor((minute - start) / width))).alias("idx"))
             .agg(F.count_distinct("icao24").alias("_x")))
    return series.join(exact, "idx", "left").select(
        "idx", "bucket_start", "events_total", F.coalesce("_x", F.lit(0)).alias("aircraft_exact"),
        within_error("aircraft_total", F.coalesce("_x", F.lit(0))).alias("in_range"))


@register("q3_metrics_answer", f"""
WITH k AS ({ORACLES["q3_kpis"]}), f AS ({ORACLES["q3_fleet_breakdown"]}), s AS ({ORACLES["q3_size_breakdown"]}),
t AS ({ORACLES["q3_aircraft_types"]}), a AS ({ORACLES["q3_activity_series"]}),
c AS ({ORACLES["w13_credits_per_request_24h"]})
select 'kpi' as part, 0 as position, 'active_aircraft' as key, cast(active_aircraft as double) as value from k
union all select 'kpi', 1, 'traffic_density', traffic_density from k
union all select 'kpi', 2, 'military_share', military_share from k
union all select 'kpi', 3, 'defense_score', defense_score from k
union all select 'kpi', 4, 'activity_bucket_seconds', activity_bucket_seconds from k
union all select 'kpi', 5, 'activity_window_seconds', activity_window_seconds from k
union all select 'kpi', 6, 'opensky_credits_per_request_24h',
                 (select min_by(credits_per_request_24h, instance) from c) from k
union all select 'estimate', 0, 'takeoffsLandings: planned_v1_1', null
union all select 'estimate', 1, 'noiseProxyIndex: planned_v1_1_heuristic', null
union all select 'estimate', 2, 'alerts: out_of_scope_issue_129', null
union all select 'fleet', row_number() over (order by ordinal, key) - 1, key, percent from f
union all select 'size', row_number() over (order by ordinal, key) - 1, key, percent from s
union all select 'type', row_number() over (order by count desc, key) - 1, key, percent from t
union all select 'series', idx, bucket_start::varchar, military_share_pct from a""")
def q3_metrics_answer(spark, sf):
    """The whole metrics answer, its nested lists flattened to (part, position, key, value)."""
    samples = tables(spark, sf).metric_samples
    credits = Qt.credits_per_request(samples, int(samples.agg(F.max("ts")).first()[0]))
    a = metrics_answer(_metrics(spark, sf), credits)
    number = lambda c: F.col(c).cast("double").alias("value")
    kpi = ["active_aircraft", "traffic_density", "military_share", "defense_score", "activity_bucket_seconds",
           "activity_window_seconds", "opensky_credits_per_request_24h"]
    item = lambda part, pos, key, value: F.struct(
        F.lit(part).alias("part"), pos.cast("long").alias("position"), key.alias("key"), value.cast("double").alias("value"))
    listed = lambda part, col, key, value: F.transform(
        F.col(col), lambda x, i: item(part, i, x[key].cast("string"), x[value]))
    notes = F.transform(F.map_entries("estimates.notes"), lambda e, i: item(
        "estimate", i, F.concat(e["key"], F.lit(": "), e["value"]), F.lit(None)))
    return a.select(F.inline(F.concat(
        F.array(*[item("kpi", F.lit(i), F.lit(c), F.col(c)) for i, c in enumerate(kpi)]), notes,
        listed("fleet", "fleet_breakdown", "key", "percent"), listed("size", "aircraft_sizes", "key", "percent"),
        listed("type", "aircraft_types", "key", "percent"),
        listed("series", "activity_series", "bucket_start", "military_share_pct"))))


@register("q2_point_lookup", _POS + ", " + O.LATEST_CTE + """
select l.icao24, a.registration, l.last_contact as last_seen, l.lat, l.lon, p.track_points, p.track_newest, p.track_oldest
from latest l left join aircraft a on l.icao24 = lower(trim(a.icao24)) join (
  select icao24, count(*) as track_points, max(last_contact) as track_newest, min(last_contact) as track_oldest
  from (select *, row_number() over (partition by icao24 order by last_contact desc, batch_epoch desc, event_id desc) as r
        from positions) where r <= 120 group by icao24) p on p.icao24 = l.icao24
where l.icao24 = (select min(icao24) from latest)""")
def q2_point_lookup(spark, sf):
    """Detail of one aircraft over the maintained track layout: its id prunes the scan."""
    t = tables(spark, sf)
    latest = latest_of(t)
    tracks = maintained(t, "tracks", "events", lambda out: write_tracks(t.positions, out))
    d = flight_detail(latest, t.aircraft, tracks, latest.agg(F.min("icao24")).first()[0])
    times = F.transform("track", lambda x: x["last_contact"])
    return d.select("icao24", "registration", "last_seen", "lat", "lon", F.size("track").cast("long").alias("track_points"),
                    F.array_max(times).alias("track_newest"), F.array_min(times).alias("track_oldest"))
