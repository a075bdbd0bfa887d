"""Upstream fetch accounting over a fetch log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.operators.sequence import previous_values, running_sum, time_chunk

# Fixed values -------------------------------------------------------------
CONFIGURED_QUOTA = 4000
WARN50, WARN80, WARN95 = 50.0, 80.0, 95.0
REFRESH_MS = 10_000
REFRESH_WARN_MS = 30_000
REFRESH_CRITICAL_MS = 300_000
FAILURE_BACKOFF_SECONDS = [1, 2, 5, 10, 30, 60, 300, 600, 1800, 3600]
TOKEN_BACKOFF_SECONDS = [15, 30, 60, 120, 300, 600]
RESET_RELATIVE_MAX = 1_000_000_000
RESET_PAST_SLACK = 86400
RESET_FUTURE_SLACK = 7 * 86400
# --------------------------------------------------------------------------

LOG_ORDER = ["ts", "seq"]


def _int_header(c: Column, typ: str = "int") -> Column:
    s = c.cast("string")
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast(typ))


def parse_fetch_headers(df: DataFrame, remaining: str = "remaining_raw", limit: str = "limit_raw",
                        reset: str = "reset_raw", now: str = "fetched_at") -> DataFrame:
    """Three numeric headers; an unparsable number is null.  A reset
    value in (0, 1e9) is relative seconds (now + v); an absolute value
    outside [now − 1 d, now + 7 d] is null."""
    r = _int_header(F.col(reset), "long")
    n = F.col(now)
    reset_at = (F.when((r > 0) & (r < RESET_RELATIVE_MAX), n + r)
                .when((r < n - RESET_PAST_SLACK) | (r > n + RESET_FUTURE_SLACK), F.lit(None).cast("long"))
                .otherwise(r))
    return df.select("*", _int_header(F.col(remaining)).alias("remaining"),
                     _int_header(F.col(limit)).alias("credit_limit"), reset_at.alias("reset_at"))


def credit_periods(log: DataFrame, key: str = "source_id", split_seconds: int | None = 86400) -> DataFrame:
    """A new period starts when remaining rises above the last known
    remaining.  Per row: period id, requests / events / credits used since
    the reset (the resetting row counts 0; positive drops of remaining are
    credits; a null remaining leaves credits untouched).  Failed cycles
    (token/publish errors) record nothing.

    Hot sources are split into time chunks; the running sums are prefix
    sums per chunk offset by the preceding chunks' totals."""
    ok = log.where(~F.coalesce(F.col("failed"), F.lit(False)))
    chunk = time_chunk("ts", split_seconds) if split_seconds else None
    d = previous_values(ok, [key], LOG_ORDER, ["remaining"], prefix="last_known_", chunk=chunk,
                        ignore_nulls=True)
    rem, last = F.col("remaining"), F.col("last_known_remaining")
    reset = F.coalesce(rem.isNotNull() & last.isNotNull() & (rem > last), F.lit(False))
    d = d.withColumn("is_reset", reset)
    d = running_sum(d, [key], LOG_ORDER, F.col("is_reset").cast("long"), "period", chunk=chunk)
    drop = F.when(rem.isNotNull() & last.isNotNull() & ~F.col("is_reset") & (last > rem), last - rem) \
        .otherwise(F.lit(0))
    sums = {"requests_since_reset": F.when(F.col("is_reset"), 0).otherwise(1).cast("long"),
            "events_since_reset": F.when(F.col("is_reset"), 0).otherwise(
                F.coalesce("states_count", F.lit(0))).cast("long"),
            "credits_since_reset": drop.cast("long")}
    return running_sum(d, [key, "period"], LOG_ORDER, chunk=chunk, sums=sums)


def _level(consumed: Column) -> Column:
    return (F.when(consumed >= WARN95, "WARN_95").when(consumed >= WARN80, "WARN_80")
            .when(consumed >= WARN50, "WARN_50").otherwise("NORMAL"))


def quota_levels(periods: DataFrame, key: str = "source_id", quota: int = CONFIGURED_QUOTA,
                 split_seconds: int | None = 86400) -> DataFrame:
    """consumed% = clamp((quota − remaining)/quota·100), quota = header
    limit when > 0 else configured; level ≥95/≥80/≥50; next delay 300 s /
    30 s / 10 s; a row without remaining keeps the last level.  Also the
    calculator's per-row gauges: consumed% on the last known remaining,
    average credits and events per request."""
    q = F.when(F.col("credit_limit") > 0, F.col("credit_limit")).otherwise(F.lit(quota)).cast("double")
    rem = F.col("remaining").cast("double")
    consumed = F.least(F.lit(100.0), F.greatest(F.lit(0.0), (q - rem) / q * 100.0))
    d = periods.withColumn("_lvl", F.when(F.col("remaining").isNotNull(), _level(consumed)))
    chunk = time_chunk("ts", split_seconds) if split_seconds else None
    d = previous_values(d, [key], LOG_ORDER, ["_lvl"], prefix="_prev", chunk=chunk, ignore_nulls=True)
    level = F.coalesce(F.col("_lvl"), F.col("_prev_lvl"), F.lit("NORMAL"))
    known = F.coalesce(F.col("remaining"), F.col("last_known_remaining"))
    gauge = F.when(known.isNull(), F.lit(0.0)).otherwise(
        F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.greatest(F.lit(0.0), q - known) / q * 100.0)))
    req = F.col("requests_since_reset")
    avg = lambda c: F.when(req == 0, F.lit(0.0)).otherwise(F.col(c) / req)
    return d.select(
        "*", F.when(F.col("remaining").isNotNull(), consumed).alias("consumed_pct"), level.alias("level"),
        F.when(level == "WARN_95", REFRESH_CRITICAL_MS).when(level == "WARN_80", REFRESH_WARN_MS)
        .otherwise(REFRESH_MS).alias("delay_ms"),
        gauge.alias("consumed_gauge_pct"), avg("credits_since_reset").alias("avg_credits_per_request"),
        avg("events_since_reset").alias("avg_events_per_request")).drop("_lvl", "_prev_lvl")


def failure_streaks(log: DataFrame, key: str = "source_id", split_seconds: int | None = 86400,
                    schedule=FAILURE_BACKOFF_SECONDS, token_schedule=TOKEN_BACKOFF_SECONDS) -> DataFrame:
    """The n-th consecutive failure gets backoff ``schedule[n-1]``; past
    the schedule the source is disabled.  Token cooldown follows its own
    schedule, capped at the last value.  Gaps-and-islands with chunked
    running sums (island = successes so far)."""
    chunk = time_chunk("ts", split_seconds) if split_seconds else None
    failed = F.coalesce(F.col("failed"), F.lit(False))
    d = log.withColumn("_f", failed.cast("long"))
    d = running_sum(d, [key], LOG_ORDER, (1 - F.col("_f")), "_island", chunk=chunk)
    d = running_sum(d, [key, "_island"], LOG_ORDER, F.col("_f"), "_n", chunk=chunk)
    n = F.col("_n")
    sched = F.array(*[F.lit(int(s)) for s in schedule])
    tok = F.array(*[F.lit(int(s)) for s in token_schedule])
    is_f = F.col("_f") == 1
    return d.select(
        *log.columns,
        F.when(is_f, n).otherwise(F.lit(0)).cast("long").alias("consecutive_failures"),
        F.when(is_f & (n <= len(schedule)), F.element_at(sched, n.cast("int"))).cast("long").alias("backoff_seconds"),
        (is_f & (n > len(schedule))).alias("disabled"),
        F.when(is_f, F.element_at(tok, F.least(n, F.lit(len(token_schedule))).cast("int")))
        .cast("long").alias("token_cooldown_seconds"))


def http_outcomes(log: DataFrame) -> DataFrame:
    """Request counts by outcome and duration statistics."""
    s = F.col("status")
    outcome = (F.when(F.coalesce(F.col("failed"), F.lit(False)), "exception")
               .when(s == 429, "rate_limited").when(s >= 500, "server_error")
               .when(s >= 400, "client_error").otherwise("success"))
    return log.groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("requests"),
        (F.floor(F.avg("duration_ms") * 1000.0 + 0.5) / 1000.0).alias("avg_duration_ms"),
        F.max("duration_ms").alias("max_duration_ms"))


def http_duration_quantiles(log: DataFrame, exact: bool = False) -> DataFrame:
    """A21 distribution of durations.  The default is approximate (mergeable
    summaries of a fixed size); ``exact`` counts per distinct duration, map-side
    first, and interpolates between the middle values."""
    ps = [0.5, 0.95, 0.99]
    q = (F.percentile("duration_ms", F.array(*[F.lit(p) for p in ps])) if exact
         else F.percentile_approx("duration_ms", ps, 10000))
    return log.agg(q.alias("q")).select(
        F.col("q")[0].alias("p50_ms"), F.col("q")[1].alias("p95_ms"), F.col("q")[2].alias("p99_ms"))


def counter_increase(samples: DataFrame, now: int, range_seconds: int = 86400,
                     series=("metric", "instance")) -> DataFrame:
    """Per series, the increase over (now − range, now] from in-range
    samples; a drop is a counter reset (the new value counts whole).
    Prometheus' boundary extrapolation is not reproduced."""
    series = list(series)
    win = samples.where((F.col("ts") > int(now) - range_seconds) & (F.col("ts") <= int(now)))
    d = previous_values(win, series, ["ts", "seq"], ["value"], prefix="_p_",
                        chunk=time_chunk("ts", 3600))
    v, p = F.col("value"), F.col("_p_value")
    delta = F.when(p.isNull(), F.lit(0.0)).when(v < p, v).otherwise(v - p)
    return d.groupBy(*series).agg(F.sum(delta).alias("increase"))


def credits_per_request(samples: DataFrame, now: int, range_seconds: int = 86400,
                        credits: str = "ingester_opensky_credits_used_since_reset",
                        requests: str = "ingester_opensky_requests_since_reset") -> DataFrame:
    """W13 ratio: clamp_min(increase(credits), 0) / clamp_min(increase(requests), 1),
    matched on the instance label."""
    inc = counter_increase(samples.where(F.col("metric").isin(credits, requests)), now, range_seconds)
    c = inc.where(F.col("metric") == credits).select("instance", F.col("increase").alias("_c"))
    r = inc.where(F.col("metric") == requests).select("instance", F.col("increase").alias("_r"))
    return c.join(r, "instance").select(
        "instance", (F.floor(F.greatest(F.col("_c"), F.lit(0.0)) / F.greatest(F.col("_r"), F.lit(1.0)) * 100.0
                             + 0.5) / 100.0).alias("credits_per_request_24h"))


def fixed_window_quota(requests: DataFrame, width: int, max_requests: int, key: str = "client",
                       hash_key: bool = False) -> DataFrame:
    """The n-th request of a key inside a fixed window is rejected when
    n > max (global: 1 s / 2; contact form: 900 s / 3 per hashed address)."""
    k = F.sha2(F.col(key).cast("string"), 256) if hash_key else F.col(key)
    d = requests.withColumn("_key", k).withColumn("window_start", (F.floor(F.col("ts") / width) * width).cast("long"))
    w = Window.partitionBy("_key", "window_start").orderBy("ts", "seq")
    n = F.row_number().over(w)
    return d.select(*requests.columns, "window_start", n.cast("long").alias("n_in_window"),
                    (n <= max_requests).alias("accepted")).drop("_key")


def _contested_scan(window: int, max_requests: int):
    """Sequential part of W16: seconds of contested runs in order -> accepted per second."""
    def scan(batches):
        from collections import deque

        import pandas as pd
        run, held, total = None, deque(), 0
        for pdf in batches:
            accepted = []
            for c, r, t, n, at, counts in zip(pdf["_key"], pdf["_run"], pdf["ts"], pdf["_n"],
                                              pdf["_seed_ts"], pdf["_seed_n"]):
                if (c, r) != run:  # a run starts with its head, which carries the state
                    run, held = (c, r), deque(zip(at, counts))
                    total = sum(x for _, x in held)
                while held and held[0][0] < t - window:
                    total -= held.popleft()[1]
                k = min(n, max_requests - total)
                if k > 0:
                    held.append((t, k))
                    total += k
                accepted.append(k)
            yield pd.DataFrame({"_key": pdf["_key"], "ts": pdf["ts"], "_k": accepted})
    return scan


def sliding_quota(requests: DataFrame, window: int = 60, max_requests: int = 120, key: str = "client",
                  split_seconds: int = 86400) -> DataFrame:
    """Reject when ≥ max *accepted* requests fall in [t − window, t];
    rejected requests do not count.  A request without a time has a null answer.

    The decision depends on order, but only where requests compete:

    1. Requests are counted per (client, second) before any shuffle; inside a
       second nothing expires, so the first k of it are accepted and at most
       ``max`` can be.
    2. Where fewer than ``max`` requests lie in [t − 2·window, t), everything in
       [t − window, t) was accepted, whatever came before.  Such a second is
       decided by a sum over a range frame.  Frames run per (client, stretch of
       ``split_seconds``) with the rows of two windows on either side copied in,
       so a busy client is spread over many tasks.
    3. Only the runs of other seconds are scanned in order, in pandas; a run
       starts with the last free second before it, which carries the state.  A
       client that never falls below its limit is one run, of at most one row a
       second."""
    window, max_requests = max(1, int(window)), max(1, int(max_requests))
    split = max(int(split_seconds), 4 * window)
    d = requests.select(F.col(key).alias("_key"), "seq", "ts")
    per = d.where(F.col("ts").isNotNull()).groupBy("_key", "ts").agg(
        F.least(F.count(F.lit(1)), F.lit(max_requests)).alias("_n"))

    stretch = F.floor(F.col("ts") / split)
    into = F.col("ts") - stretch * split
    near = F.when(into < 2 * window, stretch - 1).when(into >= split - 2 * window, stretch + 1)
    copies = per.select("*", stretch.alias("_home"), F.explode(F.array_compact(F.array(stretch, near))).alias("_s"))
    w = Window.partitionBy("_key", "_s").orderBy("ts")
    last = w.rangeBetween(-window, -1)
    d1 = copies.select(
        "*", F.coalesce(F.sum("_n").over(w.rangeBetween(-2 * window, -1)), F.lit(0)).alias("_two"),
        F.coalesce(F.sum("_n").over(last), F.lit(0)).alias("_one"),
        F.collect_list("ts").over(last).alias("_seed_ts"), F.collect_list("_n").over(last).alias("_seed_n"))
    free = F.col("_two") < max_requests
    d2 = d1.select("_key", "ts", "_n", "_s", "_home", free.alias("_free"),
                   F.least(F.col("_n"), F.lit(max_requests) - F.col("_one")).alias("_k"),
                   (free & ~F.coalesce(F.lead(free).over(w), F.lit(True))).alias("_head"),
                   *[F.when(free, F.col(c)).otherwise(F.array().cast("array<bigint>")).alias(c)
                     for c in ("_seed_ts", "_seed_n")]).where(F.col("_s") == F.col("_home"))

    decided = d2.where("_free").select("_key", "ts", "_k")
    runs = running_sum(d2.where(~F.col("_free") | F.col("_head")), ["_key"], ["ts"],
                       F.col("_head").cast("long"), "_run", chunk=time_chunk("ts", split))
    scanned = (runs.select("_key", "_run", "ts", "_n", "_seed_ts", "_seed_n")
               .repartition("_key", "_run").sortWithinPartitions("_key", "_run", "ts")
               .mapInPandas(_contested_scan(window, max_requests),
                            T.StructType([d.schema["_key"], T.StructField("ts", T.LongType()),
                                          T.StructField("_k", T.LongType())])))
    # heads are in both; both have the same number for them
    quota = decided.unionByName(scanned).groupBy("_key", "ts").agg(F.max("_k").alias("_k"))
    nth = F.row_number().over(Window.partitionBy("_key", "ts").orderBy("seq"))
    r, q = d.select("*", nth.alias("_nth")).alias("r"), quota.alias("q")
    return r.join(q, F.col("r._key").eqNullSafe(F.col("q._key")) & (F.col("r.ts") == F.col("q.ts")), "left").select(
        F.col("r._key").alias("client"), "seq", "r.ts",
        F.when(F.col("r.ts").isNotNull(), F.col("_nth") <= F.coalesce("_k", F.lit(0))).alias("accepted"))
