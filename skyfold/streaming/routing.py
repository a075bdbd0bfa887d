"""One watermark decides which reports pass, which are replays and which come late.

Every row of the input leaves with a route; none is dropped:

- ``passed``: the first report of its (icao24, last_contact);
- ``duplicate``: a further copy of a pair that has passed;
- ``late``: its time is behind the watermark, so whether its pair has passed
  is no longer known;
- ``no_time``: it carries no time.

The watermark is that of Spark's event-time operators: the newest time of all
earlier micro-batches less the delay, never before 1970, the same for every key
of a micro-batch.  Beside the checkpoint the stream keeps, per micro-batch, that
newest time and the pairs that have passed and are not behind the next
watermark; older pairs are late from then on and need no state.  A micro-batch
is routed by one window and one join in Spark, without a call per aircraft, and
reads only what earlier micro-batches left, so a replay gives the same routes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfold.streaming.streams import _batch_folders, _remove, _without_nan

ROUTES = ("passed", "duplicate", "late", "no_time")
_PAIR = ["icao24", "last_contact"]


@dataclass(frozen=True)
class RoutedStream:
    """The rows of a stream and how they are routed; ``routed_sink`` runs it."""
    rows: DataFrame
    delay_seconds: int
    splits: int

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.rows.schema.fields, T.StructField("route", T.StringType())])


def route_events(valid: DataFrame, delay_seconds: int = 600, splits: int = 4,
                 columns: tuple[str, ...] = ("event_id", "last_contact")) -> RoutedStream:
    """``valid`` with a ``route`` (see ROUTES): icao24, ``columns`` (which must hold
    event_id and last_contact) and route.  An aircraft's times are dealt over all
    tasks; its rows that need no pair (late, no time) over ``splits`` of them."""
    return RoutedStream(valid.select(*_without_nan(valid, ["icao24", *columns])), int(delay_seconds), int(splits))


def routed(batch: DataFrame, watermark: int, held: DataFrame | None, splits: int = 4) -> DataFrame:
    """A micro-batch with routes; ``watermark`` in seconds, ``held``: the pairs
    that have passed.  Of new copies of a pair the smallest event_id passes."""
    none = F.col("last_contact").isNull()
    late = F.coalesce(F.col("last_contact") < watermark, F.lit(False))
    alone = F.when(none | late, F.pmod(F.xxhash64("event_id"), F.lit(splits)))
    nth = F.row_number().over(Window.partitionBy(*_PAIR, alone).orderBy(F.asc_nulls_last("event_id")))
    d = batch.withColumn("_again", nth > 1)
    if held is not None:
        pairs = held.select(*[F.col(c).alias(f"_{c}") for c in _PAIR], F.lit(True).alias("_held"))
        d = d.join(pairs, d["icao24"].eqNullSafe(pairs["_icao24"]) & (d["last_contact"] == pairs["_last_contact"]), "left")
        d = d.withColumn("_again", F.col("_again") | F.coalesce("_held", F.lit(False)))
    return d.select(*batch.columns, F.when(none, "no_time").when(late, "late").when(F.col("_again"), "duplicate")
                    .otherwise("passed").alias("route"))


def _held(spark: SparkSession, path: str, delay: int) -> tuple[int | None, int, DataFrame]:
    """(newest time, watermark, pairs) that a micro-batch has left in ``path``."""
    newest = spark.read.schema("newest bigint").parquet(f"{path}/newest").first()[0]
    return newest, max(0, (newest or 0) - delay), spark.read.parquet(f"{path}/pairs")


def routed_sink(stream: RoutedStream, out: str, checkpoint: str):
    """Write every micro-batch to ``out/batch_id=N/route=...`` (overwrite: a replay
    rewrites the same rows); a reader of one route scans its folders only."""
    state, delay = f"{checkpoint}/held", stream.delay_seconds

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [n for n in _batch_folders(spark, state, "newest") if n < batch_id]
        newest, watermark, held = _held(spark, f"{state}/{before[-1]:012d}", delay) if before else (None, 0, None)
        target = f"{out}/batch_id={batch_id}"
        routed(batch, watermark, held, stream.splits).write.mode("overwrite").partitionBy("route").parquet(target)
        done = spark.read.schema(stream.schema).parquet(target)
        seen = done.agg(F.max("last_contact")).first()[0]  # one number
        newest = max((n for n in (newest, seen) if n is not None), default=None)
        pairs = done.where(F.col("route") == "passed").select(*_PAIR)
        pairs = (pairs if held is None else pairs.unionByName(held)).where(
            F.col("last_contact") >= max(0, (newest or 0) - delay))
        pairs.write.mode("overwrite").parquet(f"{state}/{batch_id:012d}/pairs")
        spark.createDataFrame([(newest,)], "newest bigint").write.mode("overwrite").parquet(
            f"{state}/{batch_id:012d}/newest")
        for old in before[:-1]:
            _remove(spark, f"{state}/{old:012d}")

    return stream.rows.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
