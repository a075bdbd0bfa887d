"""Deterministic flight-shaped views over the driver's tables.

The driver's tables (TPC-H-like plus ``events``) hold no flights.  Each view
below derives one input of the flight engine from them, so every query's work
grows with the tables.  Every view is one SQL text rendered in two dialects:
Spark (what the queries run) and DuckDB (what the oracle SQL embeds as CTEs),
so the two sides cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


@dataclass(frozen=True)
class Dialect:
    name: str

    def hex6(self, x: str) -> str:
        return f"format_string('%06x', {x})" if self.name == "spark" else f"printf('%06x', {x})"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.name == "spark" else f"({a} // {b})"

    def json_int(self, col: str, key: str) -> str:
        if self.name == "spark":
            return f"cast(get_json_object({col}, '$.{key}') as int)"
        return f"cast(json_extract_string({col}, '$.{key}') as int)"

    def epoch(self, ts: str) -> str:
        if self.name == "spark":
            return f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})"
        return f"cast(floor(epoch({ts})) as bigint)"

    def string(self) -> str:
        return "string" if self.name == "spark" else "varchar"


SPARK = Dialect("spark")
DUCK = Dialect("duck")


def positions_sql(d: Dialect, events: str = "events", extra: str = "") -> str:
    """M3 position events: one per ``events`` row (FIXTURES §3)."""
    return f"""
select event_id,
       {d.hex6('user_id')} as icao24,
       case event_type when 'error' then 'SAMU01' when 'view' then 'DRAGON7'
                       else 'AFR123' end as callsign,
       cast(case when k % 10 <> 0 then 46.5 + (k % 45) * 0.1 end as double) as lat,
       cast(-1.0 + (event_id % 65) * 0.1 as double) as lon,
       value as velocity,
       cast(k * 3.6 as double) as heading,
       cast(case when k % 7 <> 0 then k * 100.0 end as double) as geo_altitude,
       cast(k * 100.0 + 50 as double) as baro_altitude,
       cast(null as double) as vertical_rate,
       event_type = 'signup' as on_ground,
       epoch - (event_id % 3) as time_position,
       epoch as last_contact,
       cast(null as {d.string()}) as ingested_at,
       {d.idiv('epoch', '21600')} * 21600 as batch_epoch{', ' + extra if extra else ''}
from (select *, {d.json_int('props', 'k')} as k, {d.epoch('ts')} as epoch from {events}) e"""


#: Micro-batches of the out-of-order stream fixture.
STREAM_BATCHES = 5


def stream_events_sql(d: Dialect, events: str = "events") -> str:
    """The ``events`` rows as they arrive out of order, in ``STREAM_BATCHES``
    micro-batches (``mb``): neighbouring rows come in different batches, some
    carry no time (so last_contact and batch_epoch are null), and some are
    replayed, time and all, in a later batch."""
    mb = f"{d.idiv('event_id', '7')} % 4"
    cols = "event_id, user_id, event_type, value, props"
    return f"""
select {cols}, case when event_id % 89 <> 5 then ts end as ts, {mb} as mb from {events}
union all
select {cols}, ts, {mb} + 1 as mb from {events} where event_id % 97 = 3 and event_id % 89 <> 5"""


def aircraft_sql(d: Dialect, customer: str = "customer", nation: str = "nation") -> str:
    """M9 aircraft reference: one row per customer."""
    s = d.string()
    return f"""
select {d.hex6('c_custkey')} as icao24,
       n_name as country,
       case c_mktsegment when 'AUTOMOBILE' then 'Heavy' when 'BUILDING' then 'General light'
            when 'FURNITURE' then 'H2T' when 'HOUSEHOLD' then 'Large commercial' end
                                         as category_description,
       case c_custkey % 3 when 0 then 'L2J' when 1 then 'H1T' end as icao_aircraft_class,
       case c_custkey % 5 when 0 then 'AIRBUS' when 1 then 'BOEING' when 2 then 'EUROCOPTER'
            when 3 then 'CESSNA' end    as manufacturer_icao,
       case when c_custkey % 10 = 3 then null
            else case c_custkey % 5 when 0 then 'Airbus' when 1 then 'Boeing'
                 when 2 then 'Airbus Helicopters' when 3 then 'Cessna' end end as manufacturer_name,
       case c_custkey % 5 when 0 then 'A320-214' when 1 then '747-400' when 2 then 'EC145'
            when 3 then '172 Skyhawk' end as model,
       'F-' || lpad(cast(c_custkey as {s}), 5, '0') as registration,
       case c_custkey % 5 when 0 then 'A320' when 1 then 'B744' when 2 then 'EC45'
            when 3 then 'C172' end       as typecode,
       case c_custkey % 4 when 0 then true when 1 then false when 2 then false end
                                         as military_hint,
       case when c_custkey % 9 <> 0 then cast(1970 + c_custkey % 50 as int) end as year_built,
       case when c_acctbal < 0 then 'Private Owner' when c_acctbal > 9000
            then 'Civil Security' else 'Airline' end as owner_operator
from {customer} join {nation} on c_nationkey = n_nationkey"""


def fetch_log_sql(d: Dialect, orders: str = "orders") -> str:
    """M16 fetch log: one upstream poll per order, one source per priority."""
    return f"""
select o_orderpriority as source_id,
       {d.epoch('o_orderdate')} + (o_orderkey % 86400) as ts,
       o_orderkey as seq,
       cast(o_orderkey % 50 as int) as states_count,
       cast(case when o_orderkey % 17 <> 0 then 400 - (o_orderkey % 400) end as int) as remaining,
       cast(case when o_orderkey % 5 <> 0 then 400 end as int) as credit_limit,
       case when o_orderkey % 11 <> 0 then {d.epoch('o_orderdate')} + 86400 end as reset_at,
       cast(case o_orderstatus when 'P' then 503
                 else case when o_orderkey % 13 = 0 then 429
                           when o_orderkey % 29 = 0 then 404 else 200 end end as int) as status,
       cast(o_totalprice / 100.0 as double) as duration_ms,
       o_orderstatus = 'P' as failed
from {orders}"""


def requests_sql(d: Dialect, events: str = "events") -> str:
    """Request log for the quota operators: one request per event."""
    return f"""
select 'c' || cast(user_id % 40 as {d.string()}) as client, event_id as seq,
       {d.epoch('ts')} as ts
from {events}"""


METRIC_NAMES = {
    "click": "processor_queue_depth",
    "view": "ingester_opensky_requests_since_reset",
    "error": "up",
    "purchase": "ingester_opensky_backoff_seconds",
    "signup": "ingester_opensky_credits_used_since_reset",
}


def metric_samples_sql(d: Dialect, events: str = "events") -> str:
    """M17 metric samples (long form: one label column ``instance``)."""
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in METRIC_NAMES.items())
    return f"""
select case event_type {cases} end as metric,
       'i' || cast(user_id % 3 as {d.string()}) as instance,
       {d.epoch('ts')} as ts,
       event_id as seq,
       case when event_type = 'error' then cast(case when value >= 10 then 1.0 else 0.0 end as double)
            else value end as value
from {events}"""


def alert_samples_sql(d: Dialect, events: str = "events") -> str:
    """M17 samples of the alert metrics: every event is a scrape of one of two
    instances, a minute apart, with spells in which a condition holds, short
    and long ones, and spells without any scrape (stale series)."""
    t = "(1700000000 + event_id * 60)"
    blk = lambda n, m, r: f"{d.idiv('event_id', str(n))} % {m} = {r}"
    metrics = [
        ("up", "null", f"case when {blk(40, 9, 2)} or {blk(2, 23, 4)} then 0 else 1 end"),
        ("processor_last_processed_epoch", "null", f"{t} - case when {blk(50, 6, 3)} or {blk(2, 29, 3)} then 700 else 20 end"),
        ("processor_queue_depth", "null", f"case when {blk(30, 7, 4)} or {blk(3, 11, 2)} then 600 else 100 + event_id % 50 end"),
        ("ingester_opensky_backoff_seconds", "null", f"case when {blk(25, 8, 5)} or {blk(2, 31, 9)} then 30 else 0 end"),
        ("ingester_opensky_disabled", "null", f"case when {blk(9, 17, 1)} or event_id % 37 = 5 then 1 else 0 end"),
        ("ingester_opensky_states_http_requests_total", "'rate_limited'",
         f"{d.idiv('(event_id % 2000)', '200')} * 40 + least(event_id % 200, 40) + {d.idiv('event_id', '700')}"),
        ("ingester_opensky_states_http_requests_total", "'success'", "event_id"),
    ]
    return " union all ".join(f"""
select '{m}' as metric, 'i' || cast(event_id % 2 as {d.string()}) as instance, cast({o} as {d.string()}) as outcome,
       {t} as ts, event_id as seq, cast({v} as double) as value
from {events} where {d.idiv('event_id', '100')} % 11 <> 7""" for m, o, v in metrics)


def flow_logs_sql(d: Dialect, lineitem: str = "lineitem") -> str:
    """M18 flow-log lines: 14 space-separated fields per lineitem row."""
    s = d.string()
    start = f"({d.epoch('l_shipdate')} + ((l_orderkey * 7 + l_linenumber * 13) % 86400))"
    fields = [
        "'2'", "'123456789012'", f"'eni-' || cast(l_suppkey as {s})",
        f"'10.0.' || cast(l_partkey % 256 as {s}) || '.' || cast(l_orderkey % 256 as {s})",
        f"'10.1.0.' || cast(l_suppkey % 256 as {s})",
        f"cast(1024 + l_orderkey % 5000 as {s})",
        f"case l_linenumber % 4 when 0 then '443' when 1 then '22' when 2 then '80' else '3389' end",
        "'6'", f"cast(cast(floor(l_quantity) as bigint) as {s})", f"cast(cast(floor(l_extendedprice) as bigint) as {s})",
        f"cast({start} as {s})", f"cast({start} + 60 as {s})",
        "case l_returnflag when 'R' then 'REJECT' else 'ACCEPT' end",
        "case when l_linenumber = 7 then 'NODATA' else 'OK' end",
    ]
    return f"""
select {start} as ts, concat_ws(' ', {', '.join(fields)}) as message
from {lineitem}"""


PHOTO_HOSTS = ["t.plnspttrs.net", "cdn.planespotters.net", "evil.example.com"]


def photo_payloads_sql(d: Dialect, part: str = "part", customer: str = "customer") -> str:
    """Photo lookups: one by hex and one by registration per aircraft.

    The response body is plain JSON text; the parser (N18) must recover the
    intended photo record from it."""
    s = d.string()
    # Mix of trusted / untrusted hosts and http vs https, error and empty bodies.
    host = (f"case c_custkey % 7 when 0 then 'http://t.plnspttrs.net' "
            f"when 1 then 'https://evil.example.com' when 2 then 'https://cdn.planespotters.net' "
            f"else 'https://t.plnspttrs.net' end")
    photo = (f"'{{\"photos\":[{{\"id\":\"' || cast(c_custkey as {s}) || '\","
             f"\"thumbnail\":{{\"src\":\"' || {host} || '/t/' || cast(c_custkey as {s}) || '.jpg\","
             f"\"size\":{{\"width\":' || cast(200 + c_custkey % 3 as {s}) || ',\"height\":133}}}},"
             f"\"thumbnail_large\":{{\"src\":\"https://t.plnspttrs.net/l/' || cast(c_custkey as {s}) || '.jpg\","
             f"\"size\":{{\"width\":\"420\",\"height\":280}}}},"
             f"\"link\":\"https://www.planespotters.net/photo/' || cast(c_custkey as {s}) || '\","
             f"\"photographer\":\" P' || cast(c_custkey % 97 as {s}) || ' \"}}]}}'")
    body = (f"case when c_custkey % 6 = 0 then '{{\"error\":\"quota\"}}' "
            f"when c_custkey % 6 = 1 then '{{\"photos\":[]}}' else {photo} end")
    hex_key = d.hex6("c_custkey")
    return f"""
select 'hex' as lookup_kind, {hex_key} as lookup_key,
       cast(case when c_custkey % 11 = 0 then 404 when c_custkey % 13 = 0 then 429 else 200 end as int)
           as http_status,
       {body} as body,
       cast(1704067200 + c_custkey * 37 % 604800 as bigint) as fetched_at
from {customer}
union all
select 'reg', 'F-' || lpad(cast(c_custkey as {s}), 5, '0'),
       cast(case when c_custkey % 4 = 0 then 404 else 200 end as int),
       case when c_custkey % 5 = 0 then '{{\"photos\":[]}}' else {photo} end,
       cast(1704067200 + c_custkey * 53 % 604800 as bigint)
from {customer}"""


VIEWS = {
    "positions": positions_sql,
    "aircraft": aircraft_sql,
    "fetch_log": fetch_log_sql,
    "requests": requests_sql,
    "metric_samples": metric_samples_sql,
    "alert_samples": alert_samples_sql,
    "flow_logs": flow_logs_sql,
    "photo_payloads": photo_payloads_sql,
}


def duck_ctes(*names: str) -> str:
    """``WITH`` clause defining the named views for the DuckDB oracle."""
    parts = [f"{n} AS ({VIEWS[n](DUCK)})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"


class Tables:
    """Lazy table access for one scale-factor folder."""

    def __init__(self, spark, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict = {}

    def base(self, name: str):
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def _registered(self, name: str) -> str:
        """Register a base table as a session temp view with a folder-unique name."""
        import hashlib
        tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:8]
        vname = f"skyfold_{name}_{tag}"
        key = "reg:" + name
        if key not in self._cache:
            self.base(name).createOrReplaceTempView(vname)
            self._cache[key] = vname
        return vname

    def view(self, name: str):
        key = "view:" + name
        if key not in self._cache:
            import inspect
            fn = VIEWS[name]
            params = [p for p in inspect.signature(fn).parameters if p not in ("d", "extra")]
            sql = fn(SPARK, **{p: self._registered(p) for p in params})
            self._cache[key] = self.spark.sql(sql)
        return self._cache[key]

    def __getattr__(self, name):
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEWS:
            return self.view(name)
        if name in SPARK_ONLY_VIEWS:
            return spark_only_view(self, name)
        if name in BASE_TABLES:
            return self.base(name)
        raise AttributeError(name)


# ---------------------------------------------------------------- reference-build inputs
# Text inputs of the aircraft-reference build (S3, S4), rendered from tables
# so their size follows the scale factor: one CSV line per customer, one
# NDJSON line per part.  Spark-only: the oracle states the decoded values.

def aircraft_csv_lines_sql(customer: str) -> str:
    hexkey = SPARK.hex6("c_custkey - case when c_custkey % 7 = 0 then 1 else 0 end")
    cells = [
        f"case when c_custkey % 50 = 0 then ' ' else upper({hexkey}) end",
        "'N' || cast(c_nationkey as string)",
        "case c_mktsegment when 'AUTOMOBILE' then '''Heavy, multi-engine''' "
        "when 'BUILDING' then '''O''''Brien light''' when 'FURNITURE' then 'H2T' else '  ' end",
        "case when c_custkey % 3 = 0 then 'L2J' else '' end",
        "'M' || cast(c_custkey % 13 as string)",
        "case when c_custkey % 4 = 0 then '' else ' Maker ' || cast(c_custkey % 13 as string) || ' ' end",
        "c_name",
        "case when c_custkey % 6 = 0 then '' else 'F-' || lpad(cast(c_custkey as string), 5, '0') end",
        "case c_custkey % 5 when 0 then 'A320' when 1 then 'B744' when 2 then '' else 'C172' end",
    ]
    return f"""
select 0 as line_no, 'icao24,country,categoryDescription,icaoAircraftClass,manufacturerIcao,manufacturerName,model,registration,typecode' as line
union all
select c_custkey as line_no, concat_ws(',', {', '.join(cells)}) as line from {customer}"""


def supplement_lines_sql(part: str) -> str:
    icao = SPARK.hex6("p_partkey % 1800")
    obj = ("'{\"icao\":\"' || case when p_partkey % 83 = 0 then 'zz' || cast(p_partkey as string) "
           f"when p_partkey % 2 = 0 then upper({icao}) else {icao} end || '\"'"
           " || ',\"reg\":' || case p_partkey % 3 when 0 then '\"N' || cast(p_partkey as string) || '\"' "
           "when 1 then '\"  \"' else 'null' end"
           " || ',\"icaotype\":\"T' || cast(p_partkey % 17 as string) || '\",\"short_type\":\"L1P\"'"
           " || ',\"manufacturer\":\" ' || p_brand || ' \",\"model\":\"' || p_type || '\"'"
           " || ',\"mil\":' || case p_partkey % 6 when 0 then 'true' when 1 then '1' when 2 then '\"yes\"' "
           "when 3 then '\"0\"' when 4 then '0' else '\"maybe\"' end"
           " || ',\"year\":' || case p_partkey % 5 when 0 then cast(1950 + p_partkey % 70 as string) "
           "when 1 then '\"' || cast(1990 + p_partkey % 30 as string) || '\"' when 2 then '\"19x5\"' "
           "when 3 then '1850' else '2015.0' end"
           " || ',\"ownop\":' || case when p_partkey % 4 = 0 then '\"Private ' || cast(p_partkey as string) "
           "|| '\"' else '\"\"' end || '}'")
    return f"""
select p_partkey as line_no,
       case when p_partkey % 97 = 0 then '{{not json' when p_partkey % 89 = 0 then '[1, 2]' else {obj} end as line
from {part}"""


def state_responses_sql(positions_sql_text: str) -> str:
    """Upstream poll bodies: one JSON response per position event (states as
    positional arrays), with a non-array sibling row, a non-array ``states``
    and malformed bodies mixed in."""
    num = lambda c: f"coalesce(cast({c} as string), 'null')"
    cells = ", ".join([
        "'\"' || icao24 || '\"'", "'\"' || rpad(callsign, 8, ' ') || '\"'", "'\"France\"'",
        num("time_position"), num("last_contact"), num("lon"), num("lat"), num("baro_altitude"),
        "case when on_ground then 'true' else 'false' end", num("velocity"), num("heading"), "'null'", "'null'",
        num("geo_altitude"), "'null'", "'false'", "'0'"])
    state = f"'[' || concat_ws(',', {cells}) || ']'"
    return f"""
select event_id, batch_epoch as fetched_at,
  case when event_id % 211 = 0 then '{{"time": ' || cast(batch_epoch as string) || ', "states": [['
       when event_id % 101 = 0 then '{{"time": ' || cast(batch_epoch as string) || ', "states": null}}'
       when event_id % 13 = 0 then '{{"time": ' || cast(batch_epoch as string) || ', "states": ["junk", '
            || {state} || ']}}'
       else '{{"time": ' || cast(batch_epoch as string) || ', "states": [' || {state} || ']}}' end as body
from ({positions_sql_text}) p"""


def wire_payloads_sql(positions_sql_text: str) -> str:
    """Queue payloads as published (K1 form), with malformed payloads (an
    unclosed array around the whole record), blank keys (spaces, a tab) and
    fields of the wrong type mixed in; some keys are padded or in upper case,
    and some numbers are strings."""
    key = """case when event_id % 89 = 0 then '  ' when event_id % 83 = 0 then '\\t'
            when event_id % 5 = 1 then concat('\\t', upper(icao24), ' ') else icao24 end"""
    rest = """'callsign', callsign, 'lon', lon, 'velocity', velocity, 'heading', heading,
            'geo_altitude', geo_altitude, 'baro_altitude', baro_altitude, 'on_ground', on_ground,
            'time_position', time_position, 'opensky_fetch_epoch', batch_epoch,
            'ingested_at', '2024-01-01T00:00:00Z', 'extra', 1"""
    return f"""
select event_id,
  case when event_id % 97 = 0 then '[' || to_json(struct(*))
       when event_id % 79 = 0 then to_json(named_struct('icao24', {key}, 'lat', 'oops', 'last_contact', last_contact, {rest}))
       when event_id % 11 = 2 then to_json(named_struct('icao24', {key}, 'lat', cast(lat as string),
            'last_contact', cast(last_contact as string), {rest}))
       else to_json(named_struct('icao24', {key}, 'lat', lat, 'last_contact', last_contact, {rest})) end as value
from ({positions_sql_text}) p"""


SPARK_ONLY_VIEWS = {
    "state_responses": (lambda ev: state_responses_sql(positions_sql(SPARK, ev)), ["events"]),
    "wire_payloads": (lambda ev: wire_payloads_sql(positions_sql(SPARK, ev)), ["events"]),
    "aircraft_csv_lines": (aircraft_csv_lines_sql, ["customer"]),
    "supplement_lines": (supplement_lines_sql, ["part"]),
}


def spark_only_view(t: "Tables", name: str):
    fn, deps = SPARK_ONLY_VIEWS[name]
    key = "sview:" + name
    if key not in t._cache:
        t._cache[key] = t.spark.sql(fn(*[t._registered(d) for d in deps]))
    return t._cache[key]
