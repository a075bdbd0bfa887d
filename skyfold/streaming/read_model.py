"""A read model that one stream writes and that is compacted while it runs.

Every micro-batch is parsed once and reduced to one *delta* per table, keyed as
the table is:

- ``latest``: per aircraft the newest points (the newest two are the latest and
  the previous event), the number of events, and the newest known membership;
- ``activity``: per bucket event counts and mergeable sketches of the distinct
  aircraft.  A report that comes after its bucket has closed is a correction: its
  counts and sketches merge into the bucket and ``late_events`` says how many;
  reports without a time are the row with a null bucket.  Nothing is dropped;
- ``attributes``: event counts by attribute value.

A table is its base plus at most ``max_deltas`` deltas; reading merges them with
one partial aggregation.  Beyond that the stream itself writes a new base.
What is current is said by a manifest file that is written beside and renamed,
so a reader sees the state before a step or after it; files that neither of
the two newest manifests names are removed.  A replayed micro-batch that the
manifest already covers changes nothing; one that does not rewrites its own
delta folder.

All state is in these tables: no Python and no state store, and a busy
aircraft's rows are cut to its newest points and to partial aggregates before
they are shuffled."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.operators.activity import HLL_LG_K, bucket_epoch, bucket_ttl_seconds
from skyfold.operators.enrich import enrich_events
from skyfold.operators.filters import Bbox
from skyfold.operators.latest import EVENT_ORDER, TRACK_WRITE_LENGTH
from skyfold.operators.metrics import events_by_attribute

TABLES = ("latest", "activity", "attributes")
_POINT = [*EVENT_ORDER, "callsign", "lat", "lon", "heading", "velocity", "geo_altitude", "baro_altitude", "on_ground"]


def _newest(points: Column, n: int) -> Column:
    """The ``n`` newest of an array of points; structs compare by the event order,
    nulls as oldest."""
    return F.slice(F.sort_array(points, asc=False), 1, n)


def latest_delta(batch: DataFrame, bbox: Bbox, track_length: int) -> DataFrame:
    """(icao24, track, events, known): a micro-batch's newest points, newest first."""
    order = [F.col(c).desc_nulls_last() for c in EVENT_ORDER]
    nth = F.row_number().over(Window.partitionBy("icao24").orderBy(*order))
    points = batch.withColumn("_n", nth).where(F.col("_n") <= track_length).groupBy("icao24").agg(
        _newest(F.collect_list(F.struct(*_POINT)), track_length).alias("track"))
    inside = (F.col("lat").between(bbox.min_lat, bbox.max_lat) & F.col("lon").between(bbox.min_lon, bbox.max_lon))
    known = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(),
                   F.struct(*EVENT_ORDER, F.coalesce(inside, F.lit(False)).alias("inside")))
    counts = batch.groupBy("icao24").agg(F.count(F.lit(1)).alias("events"), F.max(known).alias("known"))
    return points.join(counts, "icao24")


def activity_delta(enriched: DataFrame, width: int, newest: int | None, closing_seconds: int) -> DataFrame:
    """Bucket counts and sketches of a micro-batch; ``late_events`` counts the
    reports of buckets that had closed when they came (``newest``: the newest
    time of earlier micro-batches)."""
    mil = F.coalesce(F.col("military_hint"), F.lit(False))
    bucket = bucket_epoch("last_contact", width)
    late = F.lit(False) if newest is None else bucket + max(1, int(width)) + int(closing_seconds) <= F.lit(int(newest))
    return enriched.groupBy(bucket.alias("bucket_epoch")).agg(
        F.count(F.lit(1)).alias("events_total"), F.count_if(mil).alias("events_military"),
        F.count_if(late).alias("late_events"), F.max("last_contact").alias("newest"),
        F.hll_sketch_agg("icao24", HLL_LG_K).alias("aircraft_sketch"),
        F.hll_sketch_agg(F.when(mil, F.col("icao24")), HLL_LG_K).alias("military_sketch"))


def merged(name: str, rows: DataFrame, track_length: int = TRACK_WRITE_LENGTH) -> DataFrame:
    """Base and deltas of a table as one row per key, in the delta's own columns."""
    total = lambda *cols: [F.sum(c).cast("long").alias(c) for c in cols]
    if name == "latest":
        return rows.groupBy("icao24").agg(
            _newest(F.flatten(F.collect_list("track")), track_length).alias("track"), *total("events"),
            F.max("known").alias("known"))
    if name == "activity":
        return rows.groupBy("bucket_epoch").agg(
            *total("events_total", "events_military", "late_events"), F.max("newest").alias("newest"),
            F.hll_union_agg("aircraft_sketch").alias("aircraft_sketch"),
            F.hll_union_agg("military_sketch").alias("military_sketch"))
    return rows.groupBy("attribute", "value").agg(*total("events"))


class ReadModel:
    """The tables under ``path``; one writer, any number of readers."""

    def __init__(self, spark: SparkSession, path: str, bbox: Bbox | None = None, width: int = 60,
                 closing_seconds: int = 600, max_deltas: int = 8, track_length: int = TRACK_WRITE_LENGTH):
        self.spark, self.path, self.bbox = spark, path.rstrip("/"), bbox or Bbox.default()
        self.width, self.closing, self.max_deltas = width, closing_seconds, max_deltas
        self.track_length = track_length
        self._jvm = spark.sparkContext._jvm
        self._fs = self._file("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ manifest
    def _file(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        at = self._file(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def manifests(self) -> list[dict]:
        """All complete manifests, oldest first."""
        out = []
        for name in self._names("manifest"):
            if name.endswith(".json"):
                text = self.spark.read.text(f"{self.path}/manifest/{name}", wholetext=True).first()[0]
                out.append(json.loads(text))
        return out

    def current(self) -> dict:
        """The newest manifest."""
        names = [n for n in self._names("manifest") if n.endswith(".json")]
        if not names:
            return {"n": 0, "through": -1, "newest": None, "tables": {t: {"base": None, "deltas": []} for t in TABLES}}
        return json.loads(self.spark.read.text(f"{self.path}/manifest/{names[-1]}", wholetext=True).first()[0])

    def _commit(self, manifest: dict) -> None:
        manifest = {**manifest, "n": manifest["n"] + 1}
        name = f"{manifest['n']:012d}.json"
        beside = self._file(f"manifest/.{name}.{uuid.uuid4().hex}")
        out = self._fs.create(beside)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._fs.rename(beside, self._file(f"manifest/{name}")):
            raise RuntimeError(f"another writer has committed {name}")

    def vacuum(self, keep: int = 2) -> None:
        """Remove what the ``keep`` newest manifests do not name."""
        names = [n for n in self._names("manifest") if n.endswith(".json")]
        kept = self.manifests()[-keep:]
        named = {p for m in kept for t in m["tables"].values() for p in [t["base"], *t["deltas"]] if p}
        for old in names[:-keep]:
            self._fs.delete(self._file(f"manifest/{old}"), True)
        for top in ("base", "delta"):
            for folder in self._names(top):
                for table in self._names(f"{top}/{folder}"):
                    if f"{top}/{folder}/{table}" not in named:
                        self._fs.delete(self._file(f"{top}/{folder}/{table}"), True)
                if not self._names(f"{top}/{folder}"):
                    self._fs.delete(self._file(f"{top}/{folder}"), True)

    # ------------------------------------------------------------ writing
    def apply(self, batch: DataFrame, aircraft: DataFrame, batch_id: int) -> None:
        """Add one micro-batch of parsed events to all tables."""
        manifest = self.current()
        if batch_id <= manifest["through"]:
            return  # a replay of what is committed
        batch = batch.persist()  # one parse for all tables
        enriched = enrich_events(batch, aircraft)
        deltas = {"latest": latest_delta(batch, self.bbox, self.track_length),
                  "activity": activity_delta(enriched, self.width, manifest["newest"], self.closing),
                  "attributes": events_by_attribute(enriched)}
        for name, delta in deltas.items():
            at = f"delta/{batch_id:012d}/{name}"
            delta.write.mode("overwrite").parquet(f"{self.path}/{at}")
            manifest["tables"][name]["deltas"].append(at)
        batch.unpersist()
        seen = self.spark.read.parquet(f"{self.path}/delta/{batch_id:012d}/activity").agg(F.max("newest")).first()[0]
        manifest["newest"] = max((x for x in (manifest["newest"], seen) if x is not None), default=None)
        manifest["through"] = batch_id
        self._commit(manifest)
        if any(len(t["deltas"]) > self.max_deltas for t in manifest["tables"].values()):
            self.compact()

    def writer(self, valid: DataFrame, aircraft: DataFrame, checkpoint: str):
        """The one query that keeps all tables."""
        return (valid.writeStream.foreachBatch(lambda batch, batch_id: self.apply(batch, aircraft, batch_id))
                .option("checkpointLocation", checkpoint))

    def _rebase(self, manifest: dict, name: str, rows: DataFrame) -> None:
        at = f"base/{manifest['n']:012d}-{uuid.uuid4().hex[:8]}/{name}"
        rows.write.parquet(f"{self.path}/{at}")
        manifest["tables"][name] = {"base": at, "deltas": []}

    def compact(self) -> None:
        """New bases from bases and deltas; readers go on with the old files meanwhile."""
        manifest = self.current()
        for name in TABLES:
            if manifest["tables"][name]["deltas"]:
                self._rebase(manifest, name, self._read(manifest, name))
        self._commit(manifest)
        self.vacuum()

    def expire(self, now: int, retention_seconds: int) -> DataFrame:
        """Take the buckets whose life ends by ``now`` out of the activity table and
        list them in ``expired`` (bucket_epoch, events_total, expired_at); a bucket lives
        max(width, retention + width) seconds.  Returns the buckets that this call took
        out.  The old files go with the second next commit, or with ``vacuum(1)``."""
        manifest = self.current()
        ends = F.col("bucket_epoch") + bucket_ttl_seconds(self.width, retention_seconds)
        rows = self._read(manifest, "activity")
        gone = f"{self.path}/expired/n={manifest['n']}"
        rows.where(ends <= int(now)).select("bucket_epoch", "events_total", ends.alias("expired_at")).write.mode(
            "overwrite").parquet(gone)
        self._rebase(manifest, "activity", rows.where(F.col("bucket_epoch").isNull() | (ends > int(now))))
        self._commit(manifest)
        self.vacuum()
        return self.spark.read.parquet(gone)

    # ------------------------------------------------------------ reading
    def _read(self, manifest: dict, name: str) -> DataFrame:
        t = manifest["tables"][name]
        paths = [f"{self.path}/{p}" for p in [t["base"], *t["deltas"]] if p]
        if not paths:
            raise ValueError(f"no micro-batch has been written to {self.path}")
        return merged(name, self.spark.read.parquet(*paths), self.track_length)

    def table(self, name: str) -> DataFrame:
        """A table as of now, one row per key."""
        return self._read(self.current(), name)

    def latest(self) -> DataFrame:
        """Latest event with its predecessor, number of events and membership per aircraft."""
        point, before = F.get("track", F.lit(0)), F.get("track", F.lit(1))
        return self.table("latest").select(
            "icao24", *[point[c].alias(c) for c in _POINT],
            *[before[c].alias(f"prev_{c}") for c in ("lat", "lon", "heading", "velocity", "last_contact")],
            F.coalesce(before["geo_altitude"], before["baro_altitude"]).alias("prev_altitude"),
            "events", F.size("track").cast("long").alias("track_points"), F.col("known.inside").alias("inside"))

    def activity(self) -> DataFrame:
        """Counts per bucket, distinct aircraft from the sketches, late reports."""
        return self.table("activity").select(
            "bucket_epoch", "events_total", "events_military", "late_events",
            F.hll_sketch_estimate("aircraft_sketch").alias("aircraft_total"),
            F.hll_sketch_estimate("military_sketch").alias("aircraft_military"), "aircraft_sketch", "military_sketch")
