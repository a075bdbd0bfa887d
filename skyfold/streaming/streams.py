"""Structured Streaming jobs.

Sources are file streams (Kafka in production); every stateful step keeps
bounded per-key state in the state store; sinks are idempotent per
micro-batch (``foreachBatch`` overwrites ``batch_id=N``), so a replay after
an executor or driver loss rewrites the same output."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql import types as T
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from skyfold.operators.activity import HLL_LG_K, bucket_ttl_seconds
from skyfold.operators.enrich import enrich_events
from skyfold.operators.filters import Bbox
from skyfold.operators.latest import TRACK_WRITE_LENGTH
from skyfold.operators.metrics import events_by_attribute
from skyfold.session import ensure_checkpoint_dir
from skyfold.sources import readers as Rd

# Fixed values -------------------------------------------------------------
STATE_STORE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ACTIVITY_WATERMARK_SECONDS = 172_800  # bucket retention (48 h) bounds window state
# --------------------------------------------------------------------------


def stream_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one stream run."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def read_table_stream(spark: SparkSession, sf_dir: str, table: str, max_files: int | None = None) -> DataFrame:
    """A file stream over one table of a scale-factor folder."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    r = spark.readStream.schema(schema).option("basePath", sf_dir)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{sf_dir}/{table}.parque[t]")


def payload_stream(spark: SparkSession, source: str = "files", path: str | None = None,
                   max_files: int | None = None, **kafka_options) -> DataFrame:
    """T1 source: queue payloads as a ``value`` string column.

    ``files``: newline-delimited JSON payloads landed in a folder (what
    ``publish_events(...).write.text`` produces).  ``kafka``: the production
    queue (needs the spark-sql-kafka connector on the classpath; options such
    as ``kafka.bootstrap.servers`` / ``subscribe`` are passed through)."""
    if source == "files":
        r = spark.readStream.format("text")
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        return r.load(path)
    if source == "kafka":
        try:
            r = spark.readStream.format("kafka")
            for k, v in kafka_options.items():
                r = r.option(k, v)
            return r.load().select(F.col("value").cast("string").alias("value"))
        except Exception as e:  # noqa: BLE001
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the classpath") from e
    raise ValueError(f"unknown payload source {source!r}")


def positions_stream(events_stream: DataFrame) -> DataFrame:
    """The positions view over a stream of ``events`` rows."""
    from skyfold.sources.testdata import SPARK, positions_sql
    name = f"skyfold_events_stream_{uuid.uuid4().hex[:8]}"
    events_stream.createOrReplaceTempView(name)
    return events_stream.sparkSession.sql(positions_sql(SPARK, name))


# ---------------------------------------------------------------- state in files
def _path(spark: SparkSession, name: str):
    """(file system, path) of a name."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _batch_folders(spark: SparkSession, path: str, last: str = "") -> list[int]:
    """Micro-batches with a folder under ``path`` in which ``last`` is written to the end."""
    fs, p = _path(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n) for n in found if n.isdigit() and fs.exists(_path(spark, f"{path}/{n}/{last}/_SUCCESS")[1]))


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def _without_nan(df: DataFrame, cols: list[str]) -> list[Column]:
    """The columns with NaN as null."""
    return [F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c)
            if df.schema[c].dataType.typeName() in ("double", "float") else F.col(c) for c in cols]


def _newest_rows(d: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The row of the highest ``by`` per key (one partial aggregate)."""
    cols = [c for c in d.columns if c not in keys and c != by]
    return (d.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(by)).alias("_r"))
            .select(*keys, *[F.col("_r")[c].alias(c) for c in cols]))


class StateLog:
    """Keyed state of one stream: under ``path`` a ``delta`` per micro-batch with the
    rows it changed, and after every ``span`` of them a ``base`` with one row per
    key, so that a step reads a base and at most ``span`` deltas.

    ``before(N)`` reads what earlier micro-batches wrote, so a replay of N sees
    the same state; what a replay of the newest can read is kept."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], span: int = 8):
        self.spark, self.path, self.keys, self.span = spark, path, keys, span

    def _files(self, batch_id: int) -> tuple[int, list[int]]:
        """(batch of the newest base before ``batch_id`` or -1, the deltas since)."""
        base = max((b for b in _batch_folders(self.spark, f"{self.path}/base") if b < batch_id), default=-1)
        return base, [b for b in _batch_folders(self.spark, f"{self.path}/delta") if base < b < batch_id]

    def before(self, batch_id: int) -> DataFrame | None:
        """State before a micro-batch, one row per key; None: there is none."""
        base, deltas = self._files(batch_id)
        paths = [f"{self.path}/base/{base:012d}"] * (base >= 0) + [f"{self.path}/delta/{b:012d}" for b in deltas]
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        return rows.drop("_batch") if len(paths) == 1 else _newest_rows(rows, self.keys, "_batch")

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Keep the rows that a micro-batch changed; returns them, read again."""
        at = f"{self.path}/delta/{batch_id:012d}"
        rows.withColumn("_batch", F.lit(int(batch_id)).cast("long")).write.mode("overwrite").parquet(at)
        base, deltas = self._files(batch_id + 1)
        if base < batch_id and len(deltas) >= self.span:
            self.before(batch_id + 1).withColumn("_batch", F.lit(int(batch_id)).cast("long")).write.mode(
                "overwrite").parquet(f"{self.path}/base/{batch_id:012d}")
            for kind, limit in (("base", base), ("delta", base + 1)):
                for old in _batch_folders(self.spark, f"{self.path}/{kind}"):
                    if old < limit:
                        _remove(self.spark, f"{self.path}/{kind}/{old:012d}")
        return self.spark.read.parquet(at).drop("_batch")


@dataclass(frozen=True)
class StatefulStream:
    """The rows of a stream and the step that its keyed state takes with each
    micro-batch: ``step(rows, state before or None)`` gives the changed rows of state."""
    rows: DataFrame
    step: Callable[[DataFrame, DataFrame | None], DataFrame]
    keys: tuple[str, ...]


# ---------------------------------------------------------------- sinks
def upsert_log_sink(df: DataFrame | StatefulStream, out: str, checkpoint: str, output_mode: str = "update",
                    transform=None):
    """Write every micro-batch to ``out/batch_id=N`` (overwrite: idempotent
    on replay).  Readers keep the row of the highest batch per key.  The state of
    a ``StatefulStream`` is kept in ``checkpoint/state-log``."""
    stateful = df if isinstance(df, StatefulStream) else None

    def write(batch: DataFrame, batch_id: int):
        b = batch
        if stateful:
            log = StateLog(batch.sparkSession, f"{checkpoint}/state-log", list(stateful.keys))
            b = log.write(stateful.step(batch, log.before(batch_id)), batch_id)
        b = transform(b, batch_id) if transform else b
        b.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    if stateful:
        df, output_mode = stateful.rows, "append"
    return (df.writeStream.outputMode(output_mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint))


def read_upsert_log(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Latest row per key across the micro-batch files (one partial aggregate)."""
    return _newest_rows(spark.read.parquet(out), keys, "batch_id")


def compact_upsert_log(spark: SparkSession, out: str, keys: list[str], read=read_upsert_log) -> None:
    """Replace the micro-batch files of a stopped stream's log by one row per key
    (by what ``read(spark, out, keys)`` makes of it) under its highest batch
    number, so that readers do not rescan every update since the start.  The compacted files are written beside the log and take
    the highest batch's place; older batches go last, so that a reader or a
    restart between the steps sees the same newest rows."""
    log = spark.read.parquet(out)
    batches = sorted(r[0] for r in log.select("batch_id").distinct().collect())
    if not batches:
        return
    top = batches[-1]
    done = f"{out}-compact-{uuid.uuid4().hex[:8]}"
    read(spark, out, keys).select(*[c for c in log.columns if c != "batch_id"]).write.parquet(done)
    spark.read.parquet(done).write.mode("overwrite").parquet(f"{out}/batch_id={top}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    spark.catalog.refreshByPath(out)
    for old in batches[:-1]:
        p = path(f"{out}/batch_id={old}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    spark.catalog.refreshByPath(out)


def track_table(state: DataFrame) -> DataFrame:
    """The held tracks as a table, newest point first (rank 1)."""
    return state.select("icao24", F.posexplode("track").alias("pos", "p")).select(
        "icao24", (F.col("pos") + 1).alias("rank"), "p.event_id", "p.last_contact", "p.batch_epoch", "p.lat", "p.lon",
        "p.altitude", "p.on_ground")


def run_available_now(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()


# ---------------------------------------------------------------- T1
def stream_positions(payload_stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parse payloads (S2) and split valid events from dead letters."""
    return Rd.split_events(Rd.read_position_events(payload_stream))


# ---------------------------------------------------------------- T2–T4, T9
_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _schema(spec: str) -> StructType:
    """``"a bigint, b string"`` -> StructType (flat, simple types only)."""
    return StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in spec.split(","))])


_TRACK_SCHEMA = _schema("last_contact bigint, batch_epoch bigint, event_id bigint, lat double, "
                        "lon double, altitude double, on_ground boolean")
STATE_OUTPUT = StructType([*_schema(
    "icao24 string, event_id bigint, callsign string, lat double, lon double, heading double, velocity double, "
    "geo_altitude double, baro_altitude double, on_ground boolean, last_contact bigint, batch_epoch bigint, "
    "prev_lat double, prev_lon double, prev_heading double, prev_velocity double, prev_altitude double, "
    "prev_last_contact bigint, inside boolean, late_events bigint, track_points bigint").fields,
    T.StructField("track", T.ArrayType(_TRACK_SCHEMA))])

_LATEST_FIELDS = ["event_id", "callsign", "lat", "lon", "heading", "velocity", "geo_altitude", "baro_altitude",
                  "on_ground", "last_contact", "batch_epoch"]
_LATEST_SCHEMA = _schema(
    "event_id bigint, callsign string, lat double, lon double, heading double, velocity double, "
    "geo_altitude double, baro_altitude double, on_ground boolean, last_contact bigint, batch_epoch bigint, "
    "prev_lat double, prev_lon double, prev_heading double, prev_velocity double, prev_altitude double, "
    "prev_last_contact bigint")
# One value state per aircraft: latest + previous, membership flag, late count,
# and the order key of the event that the membership flag comes from.
_AIRCRAFT_STATE = StructType(list(_LATEST_SCHEMA.fields) + [
    T.StructField("inside", T.BooleanType()), T.StructField("late", T.LongType()),
    T.StructField("known_last_contact", T.LongType()), T.StructField("known_batch_epoch", T.LongType()),
    T.StructField("known_event_id", T.LongType())])


def _order_key(r: dict) -> tuple:
    """(last_contact, batch, id) with nulls first, as a sortable tuple."""
    return tuple((0, 0) if r[c] is None else (1, r[c]) for c in ("last_contact", "batch_epoch", "event_id"))


def _follow(prev: dict | None, r: dict) -> dict:
    """State of event ``r`` after the held latest ``prev``."""
    cur = {f: r[f] for f in _LATEST_FIELDS}
    cur |= {f"prev_{c}": prev[c] if prev else None for c in ("lat", "lon", "heading", "velocity", "last_contact")}
    cur["prev_altitude"] = prev and (prev["geo_altitude"] if prev["geo_altitude"] is not None else prev["baro_altitude"])
    return cur


def _records(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
    """Rows of the frames as dicts of plain values.

    Pandas holds a long column with nulls as floats and a boolean one as
    objects; values go back to the column's declared type, and NaN to None, so
    that state rows encode what the batch engine would hold."""
    back = {"bigint": int, "double": float, "boolean": bool, "string": str}
    kinds = {f.name: back[f.dataType.simpleString()] for f in STATE_OUTPUT.fields if f.name != "track"}
    for pdf in frames:
        cols = {c: [None if v is None or v is pd.NA or v != v else kinds[c](v) for v in pdf[c].tolist()]
                for c in pdf.columns}
        for values in zip(*cols.values()):
            yield dict(zip(cols, values))


class AircraftStateProcessor(StatefulProcessor):
    """Per-aircraft state: latest event with its predecessor (T2), the newest
    ``track_length`` track points (T3), geofence membership (T4) and a late
    counter (T9: an event older than the held latest updates the track only).

    Membership follows the newest event whose position is known, so its order
    key is part of the state: a late event cannot move it back.  A micro-batch
    is read frame by frame; only the held track and the batch's newest
    ``track_length`` points are kept at a time, whatever the batch's size.
    Frames need not be sorted: the latest event, its predecessor and the
    membership are running maxima by the event order."""

    def __init__(self, bbox: Bbox | None = None, track_length: int = TRACK_WRITE_LENGTH):
        self.bbox = bbox or Bbox.default()
        self.track_length = track_length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("aircraft", _AIRCRAFT_STATE)
        self.track = handle.getListState("track", _TRACK_SCHEMA)

    def _inside(self, r: dict) -> bool | None:
        if r["lat"] is None or r["lon"] is None:
            return None
        b = self.bbox
        return b.min_lat <= r["lat"] <= b.max_lat and b.min_lon <= r["lon"] <= b.max_lon

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        held = dict(zip(_AIRCRAFT_STATE.names, held)) if held is not None else None
        start = _order_key(held) if held else None
        late = held["late"] or 0 if held else 0
        inside = held["inside"] if held else None
        known = {"last_contact": held["known_last_contact"], "batch_epoch": held["known_batch_epoch"],
                 "event_id": held["known_event_id"]} if held and inside is not None else None
        newest: list[tuple[tuple, dict]] = []  # the two newest events of this micro-batch
        points: list[tuple] = [tuple(t) for t in self.track.get()]
        names = _TRACK_SCHEMA.names
        order = lambda t: _order_key(dict(zip(names, t)))
        for r in _records(rows):
            k = _order_key(r)
            alt = r["geo_altitude"] if r["geo_altitude"] is not None else r["baro_altitude"]
            points.append((r["last_contact"], r["batch_epoch"], r["event_id"], r["lat"], r["lon"], alt, r["on_ground"]))
            if len(points) >= 4 * self.track_length:
                points = sorted(points, key=order, reverse=True)[: self.track_length]
            if start is not None and k < start:
                late += 1
            else:
                newest = sorted([*newest, (k, r)], key=lambda x: x[0])[-2:]
            now_inside = self._inside(r)
            if now_inside is not None and (known is None or k >= _order_key(known)):
                inside, known = now_inside, r
        cur = {c: held[c] for c in _LATEST_SCHEMA.names} if held else None
        for _, r in newest:
            cur = _follow(cur, r)
        points = sorted(points, key=order, reverse=True)[: self.track_length]
        self.track.put(points)
        known = known or dict.fromkeys(("last_contact", "batch_epoch", "event_id"))
        self.state.update(tuple(cur[c] for c in _LATEST_SCHEMA.names) + (
            inside, late, known["last_contact"], known["batch_epoch"], known["event_id"]))
        out = {"icao24": key[0], **cur, "inside": inside, "late_events": late, "track_points": len(points),
               "track": [dict(zip(names, p)) for p in points]}
        # object columns: a missing number stays None and does not turn its column into floats
        yield pd.DataFrame([[out[c] for c in STATE_OUTPUT.names]], columns=STATE_OUTPUT.names, dtype=object)

    def close(self) -> None:
        pass


def _use_rocksdb(spark: SparkSession) -> None:
    """Keyed processors need the RocksDB state store."""
    if not spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)


def stream_latest_state(valid: DataFrame, bbox: Bbox | None = None) -> DataFrame:
    """Keyed state per aircraft; emits the updated state row of every
    aircraft seen in a micro-batch, with its track (newest point first)."""
    _use_rocksdb(valid.sparkSession)
    cols = ["icao24", *_LATEST_FIELDS]
    return (valid.select(*cols).groupBy("icao24")
            .transformWithStateInPandas(AircraftStateProcessor(bbox), STATE_OUTPUT, "Update", "None"))


# T2 and T4 without the track, T3 as a log ---------------------------------
_ORDER = ("last_contact", "batch_epoch", "event_id")
LATEST_OUTPUT = StructType([f for f in STATE_OUTPUT.fields if f.name != "track"])


def latest_step(batch: DataFrame, held: DataFrame | None, bbox: Bbox, track_length: int = TRACK_WRITE_LENGTH) -> DataFrame:
    """``AircraftStateProcessor`` without the track, for all aircraft of a micro-batch
    at once: the columns of LATEST_OUTPUT and ``known``, the order key of the event
    that the membership comes from.

    The two newest events of an aircraft (a task passes on two rows of each), its
    newest known position and its counts are partly taken before they are
    shuffled; a busy aircraft is no group in one task.  An event older than the
    held latest is late; both are compared by the event order, nulls first."""
    rows = batch.select(*_without_nan(batch, ["icao24", *_LATEST_FIELDS]))
    order = lambda of="": F.struct(*[F.col(of + c).alias(c) for c in _ORDER])
    nth = F.row_number().over(Window.partitionBy("icao24").orderBy(*[F.desc_nulls_last(c) for c in _ORDER]))
    event = F.struct(*_LATEST_FIELDS)
    top = rows.withColumn("_n", nth).where(F.col("_n") <= 2).groupBy("icao24").agg(
        F.max(F.when(F.col("_n") == 1, event)).alias("new"), F.max(F.when(F.col("_n") == 2, event)).alias("next"))
    placed = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct(
        order().alias("at"), (F.col("lat").between(bbox.min_lat, bbox.max_lat)
                              & F.col("lon").between(bbox.min_lon, bbox.max_lon)).alias("inside")))
    if held is None:
        schema = StructType([*LATEST_OUTPUT.fields, T.StructField("known", StructType(
            [T.StructField(c, T.LongType()) for c in _ORDER]))])
        held = batch.sparkSession.createDataFrame([], schema)
    held = held.select(F.col("icao24").alias("_key"), F.struct("*").alias("h"))
    start = held.select("_key", order("h.").alias("_start"))
    counts = rows.join(start, rows["icao24"].eqNullSafe(start["_key"]), "left").groupBy("icao24").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(order() < F.col("_start")).alias("late"), F.max(placed).alias("placed"))
    counts = counts.withColumnRenamed("icao24", "_icao24")
    d = top.join(counts, top["icao24"].eqNullSafe(counts["_icao24"]))
    d = d.join(held, d["icao24"].eqNullSafe(held["_key"]), "left")
    first = F.col("h").isNull()
    fresh, two = first | (order("new.") >= order("h.")), F.col("next").isNotNull() & (first | (order("next.") >= order("h.")))
    moved = F.col("placed").isNotNull() & (F.col("h.known").isNull() | (F.col("placed.at") >= F.col("h.known")))
    before = lambda c: F.when(two, F.col(f"next.{c}")).when(fresh, F.col(f"h.{c}"))
    high = lambda of: F.coalesce(F.col(f"{of}.geo_altitude"), F.col(f"{of}.baro_altitude"))
    return d.select(
        "icao24", *[F.when(fresh, F.col(f"new.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in _LATEST_FIELDS],
        *[before(c).otherwise(F.col(f"h.prev_{c}")).alias(f"prev_{c}") for c in ("lat", "lon", "heading", "velocity")],
        F.when(two, high("next")).when(fresh, high("h")).otherwise(F.col("h.prev_altitude")).alias("prev_altitude"),
        before("last_contact").otherwise(F.col("h.prev_last_contact")).alias("prev_last_contact"),
        F.when(moved, F.col("placed.inside")).otherwise(F.col("h.inside")).alias("inside"),
        (F.coalesce("h.late_events", F.lit(0)) + F.col("late")).cast("long").alias("late_events"),
        F.least(F.lit(int(track_length)), F.coalesce("h.track_points", F.lit(0)) + F.col("n")).cast("long").alias("track_points"),
        F.when(moved, F.col("placed.at")).otherwise(F.col("h.known")).alias("known"))


def stream_latest(valid: DataFrame, bbox: Bbox | None = None) -> StatefulStream:
    """Latest event with its predecessor, membership and late count;
    ``upsert_log_sink`` writes the row of every aircraft seen in a micro-batch."""
    box = bbox or Bbox.default()
    return StatefulStream(valid.select("icao24", *_LATEST_FIELDS), lambda batch, held: latest_step(batch, held, box), ("icao24",))


def newest_points(rows: DataFrame, n: int = TRACK_WRITE_LENGTH) -> DataFrame:
    """The ``n`` newest rows of every aircraft with their ``rank``; a task passes
    on at most ``n`` rows per aircraft (window group limit)."""
    w = Window.partitionBy("icao24").orderBy(*[F.desc_nulls_last(c) for c in _ORDER])
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= int(n))


def track_log_writer(valid: DataFrame, out: str, checkpoint: str, n: int = TRACK_WRITE_LENGTH):
    """T3 without state: every micro-batch appends its newest ``n`` points per
    aircraft to the log (idempotent per batch), the reader keeps the newest ``n``
    of all.  Points are written once, and no Python runs."""
    points = valid.select("icao24", "event_id", "last_contact", "batch_epoch", "lat", "lon",
                          F.coalesce("geo_altitude", "baro_altitude").alias("altitude"), "on_ground")
    return upsert_log_sink(points, out, checkpoint, "append", lambda b, _: newest_points(b, n).drop("rank"))


def read_track_log(spark: SparkSession, out: str, n: int = TRACK_WRITE_LENGTH) -> DataFrame:
    """The track table of a log: newest point first (rank 1), at most ``n``."""
    return newest_points(spark.read.parquet(out).drop("batch_id"), n)


def compact_track_log(spark: SparkSession, out: str, n: int = TRACK_WRITE_LENGTH) -> None:
    """The log of a stopped stream reduced to the newest ``n`` points per aircraft."""
    compact_upsert_log(spark, out, ["icao24"], lambda spark, out, _: read_track_log(spark, out, n))


# ---------------------------------------------------------------- T5–T7
def activity_windows(enriched: DataFrame, width: int, delay: str) -> DataFrame:
    """Tumbling windows ``w`` with event counts and mergeable sketches of the
    distinct aircraft; the watermark stands ``delay`` behind the newest report."""
    mil = F.coalesce(F.col("military_hint"), F.lit(False))
    ev = enriched.where(F.col("last_contact").isNotNull()) \
        .withColumn("event_time", F.timestamp_seconds("last_contact"))
    return (ev.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", f"{max(1, int(width))} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("events_total"), F.count_if(mil).alias("events_military"),
                 F.hll_sketch_agg("icao24", HLL_LG_K).alias("aircraft_sketch"),
                 F.hll_sketch_agg(F.when(mil, F.col("icao24")), HLL_LG_K).alias("military_sketch")))


def stream_activity(enriched: DataFrame, width: int = 60,
                    retention_seconds: int = ACTIVITY_WATERMARK_SECONDS) -> DataFrame:
    """T5: tumbling buckets with event counts and distinct aircraft from
    mergeable HLL sketches (lgConfigK 14, ~0.8 % error like the store's
    HyperLogLog).  Sketches stay compact for small buckets, so window state is
    small; the watermark (bucket retention) evicts old windows (T7)."""
    agg = activity_windows(enriched, width, f"{bucket_ttl_seconds(width, retention_seconds)} seconds")
    return agg.select(F.unix_seconds(F.col("w.start")).alias("bucket_epoch"), "events_total", "events_military",
                      F.hll_sketch_estimate("aircraft_sketch").alias("aircraft_total"),
                      F.hll_sketch_estimate("military_sketch").alias("aircraft_military"),
                      "aircraft_sketch", "military_sketch")


def stream_activity_series(enriched: DataFrame, display: int, width: int = 60, delay_seconds: int = 600,
                           start: int = 0) -> DataFrame:
    """T6 in append mode: minute windows chained into display windows of
    ``display`` seconds (``start`` shifts their grid).

    A display bucket is emitted once, when the watermark (newest report less
    ``delay_seconds``) passes its end; counts are summed and the minutes'
    sketches united, so distinct aircraft are those of the whole bucket.  State
    is one partial aggregate per open minute and open display bucket.  Reports
    whose minute had closed when they came are not in the series: ``ReadModel``
    corrects closed buckets, ``route_events`` lists such reports."""
    minutes = activity_windows(enriched, width, f"{max(0, int(delay_seconds))} seconds")
    shown = f"{max(1, int(display))} seconds"
    at = F.window(F.window_time("w"), shown, shown, f"{int(start) % max(1, int(display))} seconds")
    agg = minutes.groupBy(at.alias("shown")).agg(
        *[F.sum(c).cast("long").alias(c) for c in ("events_total", "events_military")],
        F.hll_sketch_estimate(F.hll_union_agg("aircraft_sketch")).alias("aircraft_total"),
        F.hll_sketch_estimate(F.hll_union_agg("military_sketch")).alias("aircraft_military"),
        F.count(F.lit(1)).alias("minutes"))
    return agg.select(F.unix_seconds(F.col("shown.start")).alias("bucket_start"), "events_total", "events_military",
                      "aircraft_total", "aircraft_military", "minutes")


def retained_buckets(buckets: DataFrame, now: int, width: int = 60,
                     retention_seconds: int = ACTIVITY_WATERMARK_SECONDS) -> DataFrame:
    """T7 at read time: a bucket lives max(width, retention + width) seconds."""
    return buckets.where(F.col("bucket_epoch") + bucket_ttl_seconds(width, retention_seconds) > int(now))


# ---------------------------------------------------------------- T8, T10
def stream_batch_updates(valid: DataFrame) -> DataFrame:
    """A row whenever the largest batch epoch of the whole latest table
    rises; older epochs that arrive late emit nothing.

    One global maximum of (epoch, earlier micro-batch first): state is one row,
    and it says in which micro-batch its epoch was first seen (the batch's
    timestamp, which a replay repeats).  Only the micro-batch that raised it
    passes the filter.  The maximum is partly taken before the shuffle."""
    now = -F.unix_micros(F.current_timestamp())
    seen = valid.where(F.col("batch_epoch").isNotNull()).select("batch_epoch", now.alias("first"))
    top = seen.agg(F.max(F.struct("batch_epoch", "first")).alias("top"))
    return top.where(F.col("top.first") == now).select(F.col("top.batch_epoch").alias("latest_batch_epoch"))


def attribute_counts_writer(enriched: DataFrame, out: str, checkpoint: str):
    """Per micro-batch A12 counts (deltas, idempotent per batch id);
    readers sum the deltas."""
    def write(batch: DataFrame, batch_id: int):
        events_by_attribute(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return enriched.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def dedupe_events(valid: DataFrame, delay_seconds: int = 600) -> DataFrame:
    """Drop replayed copies of the same report (icao24, last_contact)
    within the watermark; state for a pair expires with the watermark.  Rows
    behind the watermark or without a time do not pass; ``late_rows`` is where
    they are kept."""
    return (valid.where(F.col("last_contact").isNotNull())
            .withColumn("event_time", F.timestamp_seconds("last_contact"))
            .withWatermark("event_time", f"{int(delay_seconds)} seconds")
            .dropDuplicatesWithinWatermark(["icao24", "last_contact"]).drop("event_time"))


class LateRowsProcessor(StatefulProcessor):
    """Per key, the newest time of earlier micro-batches; emits the rows
    that are older than it by more than the delay, and those without a time."""

    def __init__(self, delay_seconds: int, columns: list[str]):
        self.delay, self.columns = delay_seconds, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", _schema("last_contact bigint"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.get()
        limit = held[0] - self.delay if held is not None else None
        top = held[0] if held is not None else None
        for pdf in rows:
            time = pd.to_numeric(pdf["last_contact"])
            if time.notna().any():
                top = int(time.max()) if top is None else max(top, int(time.max()))
            late = time.isna() if limit is None else time.isna() | (time < limit)
            if late.any():
                out = pdf.loc[late, self.columns].astype(object)
                out = out.where(out.notna(), None)
                out["reason"] = ["no_time" if t else "late" for t in time[late].isna()]
                yield out
        if top is not None:
            self.newest.update((top,))

    def close(self) -> None:
        pass


def late_rows(valid: DataFrame, delay_seconds: int = 600) -> DataFrame:
    """T9 side table: (icao24, event_id, last_contact, reason) of the rows that
    come more than ``delay_seconds`` after a newer report of their aircraft, or
    carry no time.  A row that a watermark of the same delay drops is behind the
    newest report of all aircraft; the aircraft's own newest report is what
    decides here, so that the table says which rows came out of order."""
    _use_rocksdb(valid.sparkSession)
    cols = ["event_id", "last_contact"]
    out = StructType([*_schema("icao24 string, event_id bigint, last_contact bigint, reason string").fields])
    return valid.select("icao24", *cols).groupBy("icao24").transformWithStateInPandas(
        LateRowsProcessor(int(delay_seconds), ["icao24", *cols]), out, "Append", "None")


def enrich_stream(valid: DataFrame, aircraft: DataFrame) -> DataFrame:
    """J2 on a stream: stream-static left join with the broadcast reference."""
    return enrich_events(valid, aircraft)


def _offset_total(o) -> int | None:
    """Sum the numeric leaves of a source offset (file log offset, Kafka
    partition offsets, ...); None when it carries no number."""
    import json
    if o is None:
        return None
    if isinstance(o, str):
        try:
            o = json.loads(o)
        except ValueError:
            return None
    if isinstance(o, bool):
        return None
    if isinstance(o, (int, float)):
        return int(o)
    if isinstance(o, dict):
        vals = [_offset_total(v) for v in o.values()]
        vals = [v for v in vals if v is not None]
        return sum(vals) if vals else None
    if isinstance(o, list):
        vals = [_offset_total(v) for v in o]
        vals = [v for v in vals if v is not None]
        return sum(vals) if vals else None
    return None


def stream_health(query, spark: SparkSession | None = None) -> DataFrame:
    """A15 for a running stream: per micro-batch, input rows, processing
    rate and the source backlog (latest available offset − end offset of the
    batch), from the query's progress reports (small, driver-side metadata)."""
    rows = []
    for p in query.recentProgress:
        backlog = 0
        for s in p.sources:
            latest, end = _offset_total(s.latestOffset), _offset_total(s.endOffset)
            if latest is not None and end is not None:
                backlog += max(0, latest - end)
        rows.append((int(p.batchId), int(p.numInputRows), float(p.processedRowsPerSecond or 0.0), int(backlog)))
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "batch_id bigint, input_rows bigint, rows_per_second double, backlog bigint")
