"""Table layouts for the position history and the latest table (K2 batch form).

Positions are partitioned by UTC day and sorted by latitude then longitude
inside each file, so parquet row-group statistics prune a bounding-box
filter and the day partition prunes a ``since`` filter.  The latest table is
small (one row per aircraft) and sorted the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def utc_day(epoch) -> F.Column:
    """UTC calendar day of an epoch (independent of the session zone)."""
    c = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.date_from_unix_date(F.floor(c / 86400).cast("int"))


def with_day(df: DataFrame, ts: str = "last_contact") -> DataFrame:
    return df.withColumn("day", utc_day(ts))


def write_positions(positions: DataFrame, path: str, mode: str = "append") -> None:
    """Append positions partitioned by day, bbox-clustered within files."""
    # ranges of (day, lat, lon): a busy day is many tasks and files, each a strip of latitudes
    (with_day(positions).repartitionByRange("day", "lat", "lon").sortWithinPartitions("day", "lat", "lon")
     .write.mode(mode).partitionBy("day").parquet(path))


def write_tracks(positions: DataFrame, path: str, row_group_bytes: int = 16 << 20) -> None:
    """Replace the track table that the detail answer (Q2) reads: ranges of
    (icao24, last_contact), sorted inside, in small row groups.  Row-group
    statistics then prune to one aircraft, and a busy aircraft is several files,
    each a stretch of its time."""
    order = ["icao24", "last_contact"]
    (positions.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path))


def write_latest(latest: DataFrame, path: str) -> None:
    """Replace the latest table (written beside, then swapped by the caller's
    catalog); rows clustered by latitude for bbox pruning."""
    latest.repartitionByRange("lat", "lon").sortWithinPartitions("lat", "lon").write.mode("overwrite").parquet(path)


def read_positions(spark, path: str, since: int | None = None) -> DataFrame:
    """Positions with day-partition pruning for a ``since`` bound."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.where((F.col("day") >= utc_day(F.lit(int(since))))
                      & (F.col("last_contact") >= int(since)))
    return df.drop("day")
