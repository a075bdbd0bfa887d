"""Pipeline self-monitoring: flow logs, metric samples, alert rules
(S7, S8, A18–A20, A22, W14, W18)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.schemas import FLOW_LOG_DDL
from skyfold.operators.sequence import materialize, previous_values, running_sum, time_chunk

# Fixed values -------------------------------------------------------------
FLOW_BIN_SECONDS = 300
TOP_REJECTS = 15
# --------------------------------------------------------------------------


def read_flow_logs(df: DataFrame, message: str = "message", keep_status: str | None = "OK") -> DataFrame:
    """Split the 14 space-separated fields of a flow-log message; keep
    ``log_status = 'OK'`` records."""
    parsed = materialize(df, r=F.from_csv(F.col(message), FLOW_LOG_DDL, {"sep": " "})).select(
        *[c for c in df.columns if c != message], "r.*")
    return parsed.where(F.col("log_status") == keep_status) if keep_status else parsed


METRIC_SAMPLE_DDL = "metric string, labels map<string, string>, ts timestamp, value double"


def read_metric_samples(spark, path: str, fmt: str = "parquet", labels: tuple[str, ...] = ("instance",)) -> DataFrame:
    """Typed samples from files, with the named labels as columns and the
    time as an epoch: (metric, labels, <labels>, ts, value)."""
    d = spark.read.schema(METRIC_SAMPLE_DDL).format(fmt).load(path)
    return d.select("metric", "labels", *[F.col("labels")[n].alias(n) for n in labels],
                    F.unix_seconds("ts").alias("ts"), "value")


def flows_by_action(flows: DataFrame, ts: str = "ts", width: int = FLOW_BIN_SECONDS) -> DataFrame:
    """Count per 5-minute bin and action."""
    b = (F.floor(F.col(ts) / width) * width).cast("long")
    return flows.groupBy(b.alias("bin_start"), "action").agg(F.count(F.lit(1)).alias("flows"))


def top_rejects(flows: DataFrame, col: str, n: int = TOP_REJECTS) -> DataFrame:
    """REJECT counts by ``col``, descending, top n (ties by value)."""
    return (flows.where(F.col("action") == "REJECT").groupBy(col).agg(F.count(F.lit(1)).alias("rejects"))
            .orderBy(F.col("rejects").desc(), F.col(col).asc()).limit(n))


def metric_statistics(samples: DataFrame, period: int, dims=("metric", "instance")) -> DataFrame:
    """Average / Maximum / Sum / SampleCount per metric, dimension and period."""
    p = (F.floor(F.col("ts") / period) * period).cast("long")
    return samples.groupBy(*dims, p.alias("period_start")).agg(
        F.avg("value").alias("average"), F.max("value").alias("maximum"), F.sum("value").alias("sum"),
        F.count(F.lit(1)).alias("sample_count"))


def rate_sum_by(samples: DataFrame, metric: str, now: int, label: str = "instance",
                range_seconds: int = 300) -> DataFrame:
    """Per-second counter rate over the range (W13 increase / range),
    summed by label."""
    from skyfold.operators.quota import counter_increase
    inc = counter_increase(samples.where(F.col("metric") == metric), now, range_seconds, series=("metric", label))
    return inc.groupBy(label).agg(F.sum(F.col("increase") / float(range_seconds)).alias("rate"))


@dataclass(frozen=True)
class AlertRule:
    """A condition over the instant values of a metric's series.

    ``fn``: ``last`` (newest sample), ``avg`` or ``increase`` over the range;
    ``across``: how series are put together (``max``, ``sum``, or None: each
    series by itself); ``age``: compare the time minus the value; ``labels``:
    label values that a series must have."""
    name: str
    metric: str
    fn: str
    across: str | None
    op: str                 # '<' or '>'
    threshold: float
    for_seconds: int
    age: bool = False
    outcome: str | None = None


# Fixed values -------------------------------------------------------------
ALERT_LOOKBACK_SECONDS = 300
ALERT_STEP_SECONDS = 60
ALERT_SPELL_SECONDS = 21_600
ALERT_RULES = [
    AlertRule("CriticalTargetDown", "up", "avg", None, "<", 1.0, 600),
    AlertRule("ProcessorStalled", "processor_last_processed_epoch", "last", "max", ">", 600.0, 300, age=True),
    AlertRule("RedisQueueBacklogHigh", "processor_queue_depth", "last", "max", ">", 500.0, 600),
    AlertRule("IngesterBackoffActive", "ingester_opensky_backoff_seconds", "last", "max", ">", 0.0, 600),
    AlertRule("IngesterDisabled", "ingester_opensky_disabled", "last", "max", ">", 0.0, 120),
    AlertRule("OpenSkyRateLimited", "ingester_opensky_states_http_requests_total", "increase", "sum", ">", 0.0, 600,
              outcome="rate_limited"),
]
# --------------------------------------------------------------------------


def sustained_alerts(samples: DataFrame, rules=ALERT_RULES, lookback: int = ALERT_LOOKBACK_SECONDS,
                     step: int = ALERT_STEP_SECONDS) -> DataFrame:
    """Islands in which a rule's condition holds at every evaluation, and
    whether they last for the rule's ``for`` duration.  All rules in one pass.

    ``samples``: metric, instance, outcome (a label, may be null), ts, seq, value.
    Rules are evaluated every ``step`` seconds, as the alert manager does: at a
    time g a series has the samples of (g - lookback, g], and none if it went
    quiet longer ago.  Samples are shuffled once, by metric and spell of
    ALERT_SPELL_SECONDS; those that are still seen in the next spell go there too.
    They are then reduced to one row per series and step, as all of a step are seen
    by the same evaluations (``step`` must divide ``lookback``); a step looks back at
    the lookback / step - 1 before it and stands for the evaluations up to the
    next.  Windows hold one spell of one series, and all series of a metric are put
    together in the same task.  An evaluation without samples has no value and ends
    an island."""
    if lookback % step:
        raise ValueError("the step must divide the look-back")
    # a counter that falls was reset
    grown = lambda before, after: F.when(after < before, after).otherwise(after - before)
    label, order = ["metric", "instance", "outcome"], F.struct("ts", "seq")
    spell, near = (lambda c: F.floor(c / ALERT_SPELL_SECONDS)), lookback - step
    d = samples.where(F.col("metric").isin(sorted({r.metric for r in rules})) & F.col("ts").isNotNull()).select(
        *label, "ts", "seq", "value", (F.ceil(F.col("ts") / step) * step).cast("long").alias("step"))
    d = d.withColumn("spell", F.explode(F.sequence(spell(F.col("step")), spell(F.col("step") + near))))
    d = d.repartition("metric", "spell")
    before = F.lag("value").over(Window.partitionBy("metric", "spell", "instance", "outcome", "step").orderBy("ts", "seq"))
    steps = d.withColumn("_grown", grown(before, F.col("value"))).groupBy(*label, "spell", "step").agg(
        F.sum("value").alias("total"), F.count("value").alias("n"), F.sum("_grown").alias("grown"),
        F.min_by("value", order).alias("first"), F.max_by("value", order).alias("last"))
    along = Window.partitionBy("metric", "spell", "instance", "outcome").orderBy("step")
    this = F.struct("step", "total", "n", "grown", "first", "last")
    steps = steps.select(*label, "spell", "step", F.lead("step").over(along).alias("_next"),
                         F.array(*[F.lag(this, k).over(along) for k in range(near // step, 0, -1)], this).alias("_s"))
    until = F.least(F.col("step") + near, F.col("_next") - step)
    seen = steps.withColumn("at", F.explode(F.sequence("step", until, F.lit(step).cast("long")))).where(
        spell(F.col("at")) == F.col("spell")).select(
        *label, "spell", "at", F.filter("_s", lambda x: x["step"] >= F.col("at") - near).alias("s"))
    zero = F.lit(0.0)
    # within the steps and from each to the next: both samples of an increase are seen
    grew = F.aggregate("s", F.struct(zero.alias("sum"), F.lit(None).cast("double").alias("last")), lambda acc, x: F.struct(
        (acc["sum"] + F.coalesce(x["grown"], zero) + F.coalesce(grown(acc["last"], x["first"]), zero)).alias("sum"),
        x["last"].alias("last")), lambda acc: acc["sum"])
    n = F.aggregate("s", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    mean = F.when(n > 0, F.aggregate("s", zero, lambda acc, x: acc + F.coalesce(x["total"], zero)) / n)
    spec = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.metric).alias("m"), F.lit(r.outcome).alias("o"))
                     for r in rules])
    mine = F.filter(spec, lambda r: (r["m"] == F.col("metric")) & (r["o"].isNull() | (r["o"] == F.col("outcome"))))
    series = seen.select("metric", "spell", F.explode(F.transform(mine, lambda r: r["rule"])).alias("rule"), "instance",
                         "outcome", "at",
                         F.element_at("s", -1)["last"].alias("last"), mean.alias("avg"), grew.alias("increase"))
    by = lambda f: F.col("rule").isin([r.name for r in rules if f(r)])
    value = F.when(by(lambda r: r.fn == "last"), F.col("last")).when(by(lambda r: r.fn == "avg"), F.col("avg")).otherwise(
        F.col("increase"))
    alone = by(lambda r: r.across is None)
    group = F.when(alone, F.concat_ws("/", "instance", "outcome")).otherwise("")
    # a rule has one metric and a time one spell: no further shuffle
    all_ = series.select("metric", "spell", "rule", "at", group.alias("series"), value.alias("v")).groupBy(
        "metric", "spell", "rule", "series", "at").agg(
        F.max("v").alias("max"), F.sum("v").alias("sum"))
    v = F.when(by(lambda r: r.across == "sum"), F.col("sum")).otherwise(F.col("max"))
    v = F.when(by(lambda r: r.age), F.col("at") - v).otherwise(v)
    holds = F.lit(False)
    for r in rules:
        bad = (v < r.threshold) if r.op == "<" else (v > r.threshold)
        holds = F.when(F.col("rule") == r.name, bad).otherwise(holds)
    true = all_.where(holds).select("rule", "series", "at")
    key, chunk = ["rule", "series"], time_chunk("at", 86400)
    p = previous_values(true.withColumn("before", F.col("at")), key, ["at"], ["before"], prefix="_p_", chunk=chunk)
    new = F.when(F.col("_p_before") == F.col("at") - step, 0).otherwise(1)
    isl = running_sum(p.withColumn("_new", new), key, ["at"], F.col("_new"), "_island", chunk=chunk)
    lasts = F.max("at") - F.min("at")
    due = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.for_seconds)])[F.col("rule")]
    return isl.groupBy(*key, "_island").agg(
        F.min("at").alias("start_ts"), F.max("at").alias("end_ts"), lasts.alias("duration_s"),
        F.count(F.lit(1)).alias("evaluations")).select(
        *key, "start_ts", "end_ts", "duration_s", "evaluations", (F.col("duration_s") >= due).alias("fired"))


def period_alarms(samples: DataFrame, threshold: float, period: int = 60, n: int = 2,
                  series=("metric", "instance")) -> DataFrame:
    """Per-period maximum ≥ threshold in ``n`` consecutive periods; a
    missing period is not breaching.  Each breaching period votes for itself
    and the next n−1 periods; a period with n votes closes an alarm run —
    joins and aggregates only, no ordered window."""
    series = list(series)
    per = samples.groupBy(*series, (F.floor(F.col("ts") / period) * period).cast("long").alias("period_start")) \
        .agg(F.max("value").alias("maximum"))
    br = per.where(F.col("maximum") >= threshold)
    votes = br.select(*series, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"), "period_start") \
        .select(*series, (F.col("period_start") + F.col("k") * period).alias("period_start"))
    cnt = votes.groupBy(*series, "period_start").agg(F.count(F.lit(1)).alias("votes"))
    return cnt.where(F.col("votes") >= n).select(*series, "period_start")
