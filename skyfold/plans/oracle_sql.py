"""DuckDB SQL fragments for the oracle side of ``oracle_sql()``.

Built from the same fixed word lists as the Spark expressions so both sides
read one source of truth for constants; the logic itself is written
independently in SQL."""

from __future__ import annotations

from skyfold.functions import taxonomy as tx
from skyfold.operators.filters import DEFAULT_BBOX


def nz(x: str) -> str:
    """trim-to-null."""
    return f"nullif(trim({x}), '')"


def _any_like(x: str, words) -> str:
    return "(" + " or ".join(f"coalesce({x} like '%{w}%', false)" for w in words) + ")"


def _any_prefix(x: str, prefixes) -> str:
    return "(" + " or ".join(f"coalesce({x} like '{p}%', false)" for p in prefixes) + ")"


def airframe_sql(cat: str, tc: str) -> str:
    c, t = f"lower({nz(cat)})", f"upper({nz(tc)})"
    heli = (f"({_any_like(c, tx.HELICOPTER_CATEGORY_WORDS)} or coalesce(regexp_matches({c}, '^h[0-9]'), false)"
            f" or {_any_prefix(t, tx.HELICOPTER_TYPECODE_PREFIXES)})")
    return f"(case when {heli} then 'helicopter' when {c} is not null or {t} is not null then 'airplane' end)"


def fleet_sql(mil: str, cs: str, cat: str, own: str) -> str:
    c, o, s = f"lower({nz(cat)})", f"lower({nz(own)})", f"lower({nz(cs)})"
    rescue = (f"({_any_like(o, tx.RESCUE_OWNER_WORDS)} or {_any_like(c, tx.RESCUE_CATEGORY_WORDS)}"
              f" or {_any_like(s, tx.RESCUE_CALLSIGN_WORDS)})")
    private = f"({_any_like(o, tx.PRIVATE_OWNER_WORDS)} or {_any_like(c, tx.PRIVATE_CATEGORY_WORDS)})"
    return (f"(case when coalesce({mil}, false) then 'military' when {rescue} then 'rescue'"
            f" when {private} then 'private' when {c} is null then 'unknown' else 'commercial' end)")


def size_sql(cat: str, tc: str) -> str:
    c, t = f"lower({nz(cat)})", f"upper({nz(tc)})"
    return (f"(case when {_any_like(c, tx.HEAVY_CATEGORY_WORDS)} then 'heavy'"
            f" when {_any_like(c, tx.LARGE_CATEGORY_WORDS)} then 'large'"
            f" when {_any_like(c, tx.SMALL_CATEGORY_WORDS)} then 'small'"
            f" when {t} is null then 'unknown'"
            f" when {_any_prefix(t, tx.HEAVY_TYPECODE_PREFIXES)} then 'heavy'"
            f" when {_any_prefix(t, tx.LARGE_TYPECODE_PREFIXES)} then 'large'"
            f" when {_any_prefix(t, tx.SMALL_TYPECODE_PREFIXES)} then 'small' else 'medium' end)")


def type_label_sql(cat: str, tc: str) -> str:
    return f"(case when {nz(tc)} is not null then {tc} when {nz(cat)} is not null then {cat} else 'unknown' end)"


def bbox_sql(lat="lat", lon="lon", bbox=DEFAULT_BBOX) -> str:
    mnlo, mnla, mxlo, mxla = bbox
    return f"({lat} between {mnla} and {mxla} and {lon} between {mnlo} and {mxlo})"


EVENT_ORDER_DESC = "last_contact desc nulls last, batch_epoch desc nulls last, event_id desc"

LATEST_CTE = f"""latest AS (
  select * exclude (rn) from (
    select p.*, row_number() over w as rn,
           lead(lat) over w as prev_lat, lead(lon) over w as prev_lon,
           lead(heading) over w as prev_heading, lead(velocity) over w as prev_velocity,
           lead(coalesce(geo_altitude, baro_altitude)) over w as prev_altitude,
           lead(last_contact) over w as prev_last_contact
    from positions p where icao24 is not null
    window w as (partition by icao24 order by {EVENT_ORDER_DESC})) where rn = 1)"""


def snapshot_ctes(with_owner: bool, bbox=DEFAULT_BBOX, since: int | None = None,
                  since_sql: str | None = None) -> str:
    """cand -> kept (F8) -> dedup (A1) -> snap (J1), on top of ``latest``."""
    since_cond = ""
    if since_sql is not None:
        since_cond = f" and last_contact >= ({since_sql})"
    elif since is not None:
        since_cond = f" and last_contact >= {int(since)}"
    owner = "m.owner_operator" if with_owner else "cast(null as varchar)"
    return f""",
cand AS (select * from latest where {bbox_sql(bbox=bbox)}{since_cond}),
topb AS (select distinct batch_epoch from cand where batch_epoch is not null
         order by batch_epoch desc limit 3),
kept AS (select * from cand where batch_epoch in (select batch_epoch from topb)
         or not exists (select 1 from cand where batch_epoch is not null)),
dedup AS (select * exclude (r) from (
    select *, row_number() over (partition by lower(trim(icao24))
        order by batch_epoch desc nulls last, last_contact desc nulls last, event_id desc) as r
    from kept) where r = 1),
dim AS (select lower(trim(icao24)) as ak,
        case when {nz('category_description')} is not null then category_description
             when {nz('icao_aircraft_class')} is not null then icao_aircraft_class end as category,
        country, upper({nz('typecode')}) as typecode, military_hint, owner_operator from aircraft),
snap AS (select d.*, m.category, m.country, m.typecode, m.military_hint,
        {owner} as owner_operator,
        {airframe_sql('m.category', 'm.typecode')} as airframe_type
        from dedup d left join dim m on lower(trim(d.icao24)) = m.ak)
"""


MAP_ITEM_SELECT = f"""icao24, {nz('callsign')} as callsign, lat, lon, heading, last_contact as last_seen,
  velocity as speed, coalesce(geo_altitude, baro_altitude) as altitude, military_hint,
  coalesce(airframe_type, 'unknown') as airframe_type,
  {fleet_sql('military_hint', 'callsign', 'category', 'owner_operator')} as fleet_type,
  {size_sql('category', 'typecode')} as aircraft_size,
  prev_lat, prev_lon, prev_heading, prev_velocity as prev_speed, prev_altitude,
  prev_last_contact as prev_last_seen"""


def round2_sql(x: str) -> str:
    return f"(floor(({x}) * 100.0 + 0.5) / 100.0)"
