"""Aircraft reference build.

The reference table is rebuilt from a CSV export (authoritative) and a
newline-delimited JSON supplement that fills blanks and adds missing
aircraft.  Everything is a Spark job: parse -> normalise -> last-row-wins
per key (one partial aggregate) -> one full outer join -> versioned write.
Lines cost far more to parse than to read, so they are dealt over all tasks
first: a few MB of lines would otherwise be parsed by one."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.expr import norm_icao24, py_strip_to_null, to_bool_flag, to_year
from skyfold.operators.sequence import materialize
from skyfold.schemas import AIRCRAFT, AIRCRAFT_CSV_HEADER, AIRCRAFT_OPTIONAL, AIRCRAFT_REQUIRED
from skyfold.session import shared_path

CSV_OPTIONS = {"header": "true", "sep": ",", "quote": "'", "escape": "'", "encoding": "UTF-8",
               "multiLine": "true", "mode": "PERMISSIVE"}
CSV_LINE_SCHEMA = ", ".join(f"`{c}` STRING" for c in AIRCRAFT_CSV_HEADER)
# camelCase header -> table column
CSV_TO_TABLE = dict(zip(AIRCRAFT_CSV_HEADER, AIRCRAFT_REQUIRED))


class MissingColumnsError(RuntimeError):
    pass


def require_columns(found: list[str], required=AIRCRAFT_CSV_HEADER) -> None:
    missing = [c for c in required if c not in found]
    if missing:
        raise MissingColumnsError(f"header lacks {missing}; it has {found}")


def read_aircraft_csv(spark, path: str) -> DataFrame:
    """S3 (file form): header CSV with quote char ``'``; rows carry a file
    order key (file, block, position) so that the last row per key wins."""
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    require_columns(raw.columns)
    order = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                     F.monotonically_increasing_id().alias("i"))
    return raw.select(*[F.col(c) for c in AIRCRAFT_CSV_HEADER], order.alias("_order"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dealt(lines: DataFrame, order: str) -> DataFrame:
    """``lines`` over as many tasks as a shuffle has, however few files hold them."""
    return lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(order))


def parse_aircraft_csv_lines(lines: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """S3 (column form): CSV text lines already in a table, one record per
    line (``from_csv`` with the same options).  The header line is dropped."""
    header = ",".join(AIRCRAFT_CSV_HEADER)
    body = lines.where(F.col(line) != header)
    parsed = F.from_csv(F.col(line), CSV_LINE_SCHEMA, {"sep": ",", "quote": "'", "escape": "'"})
    return materialize(_dealt(body.select(line, F.col(order).alias("_order")), "_order"), r=parsed).select("r.*", "_order")


def normalise_csv(rows: DataFrame) -> DataFrame:
    """Python-strip every cell (blank -> null), lower the key; rows without a
    key are flagged ``_skipped``."""
    cols = [py_strip_to_null(F.col(c)).alias(CSV_TO_TABLE[c]) for c in AIRCRAFT_CSV_HEADER]
    d = rows.select(*cols, "_order")
    return d.withColumn("icao24", F.lower("icao24")).withColumn("_skipped", F.col("icao24").isNull())


def apply_import_limit(norm_rows: DataFrame, limit: int) -> DataFrame:
    """S3 ``limit``: stop after ``limit`` imported rows in file order (rows
    without a key that come before the cut are still counted as skipped).
    ``orderBy + limit`` plans as a distributed top-k; the cut is one scalar."""
    if not limit or limit <= 0:
        return norm_rows
    kept = norm_rows.where(~F.col("_skipped")).orderBy("_order").limit(int(limit))
    cut = kept.agg(F.max("_order").alias("_cut"))
    skipped = norm_rows.where(F.col("_skipped")).join(F.broadcast(cut), F.col("_order") < F.col("_cut"), "left_semi")
    return kept.unionByName(skipped)


def last_row_per_key(df: DataFrame, key: str, order: str = "_order", cols: list[str] | None = None) -> DataFrame:
    """Last row wins per key: ``max_by`` over the order key (partial aggregate)."""
    cols = cols or [c for c in df.columns if c not in (key, order)]
    return (df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
            .select(key, *[F.col("_r")[c].alias(c) for c in cols]))


def parse_supplement(lines: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """One JSON object per line.  Adds ``_status``: ok / bad_json (not
    decodable or not an object) / bad_icao (key not six hex digits)."""
    body = lines.where(F.length(F.trim(F.col(line))) > 0).select(F.col(order).alias("_order"), line)
    d = materialize(_dealt(body, "_order"), _v=F.expr(f"try_parse_json({line})")).drop(line)
    keys = ("icao", "reg", "icaotype", "short_type", "manufacturer", "model", "mil", "year", "ownop")
    d = materialize(d, _obj=F.coalesce(F.expr("schema_of_variant(_v)").startswith("OBJECT"), F.lit(False)),
                    **{f"_{k}": F.expr(f"try_variant_get(_v, '$.{k}', 'string')") for k in keys},
                    **{f"_t_{k}": F.expr(f"schema_of_variant(try_variant_get(_v, '$.{k}'))") for k in ("mil", "year")})
    is_obj = F.col("_obj")
    get, typ = lambda k: F.col(f"_{k}"), lambda k: F.col(f"_t_{k}")
    d = materialize(d, _hex=norm_icao24(get("icao"), validate=True, python_strip=True))
    icao = F.col("_hex")
    mil_t, year_t = typ("mil"), typ("year")
    mil_s = get("mil")
    integral = lambda t: t.isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    mil = (F.when(mil_t == "BOOLEAN", F.when(mil_s == "true", 1).otherwise(0))
           .when(integral(mil_t), F.when(mil_s.cast("decimal(38,0)") != 0, 1).otherwise(0))
           .when(mil_t == "STRING", to_bool_flag(mil_s)))
    year = (F.when(integral(year_t), F.when(get("year").cast("decimal(38,0)").between(1900, 2100),
                                           get("year").cast("int")))
            .when(year_t == "STRING", to_year(get("year"))))
    status = F.when(~is_obj, "bad_json").when(icao.isNull(), "bad_icao").otherwise("ok")
    return d.select(
        "_order", status.alias("_status"), icao.alias("icao"),
        py_strip_to_null(get("reg")).alias("reg"), py_strip_to_null(get("icaotype")).alias("icaotype"),
        py_strip_to_null(get("short_type")).alias("short_type"),
        py_strip_to_null(get("manufacturer")).alias("manufacturer"), py_strip_to_null(get("model")).alias("model"),
        mil.cast("int").alias("mil"), year.cast("int").alias("year"), py_strip_to_null(get("ownop")).alias("ownop"))


def load_aircraft_reference(spark, path: str) -> DataFrame:
    """Read a reference table; optional enrichment columns absent from
    older files come back as typed NULL columns."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    for name, typ in AIRCRAFT_OPTIONAL:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(typ))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in AIRCRAFT.fields])


def merge_reference(csv_rows: DataFrame, supplement: DataFrame) -> DataFrame:
    """J3 + J4: full outer join on the key.  Matched rows fill blanks for
    registration, manufacturer, model, typecode and aircraft class, and take
    the supplement's military flag, year and owner when present;
    supplement-only keys are inserted with the nine columns it carries."""
    a = csv_rows.alias("a")
    b = supplement.alias("b")
    j = a.join(b, F.col("a.icao24") == F.col("b.icao"), "full")
    fill = lambda x, y: F.coalesce(F.col(f"a.{x}"), F.col(f"b.{y}"))
    return j.select(
        F.coalesce("a.icao24", "b.icao").alias("icao24"),
        F.col("a.country").alias("country"), F.col("a.category_description").alias("category_description"),
        fill("icao_aircraft_class", "short_type").alias("icao_aircraft_class"),
        F.col("a.manufacturer_icao").alias("manufacturer_icao"),
        fill("manufacturer_name", "manufacturer").alias("manufacturer_name"),
        fill("model", "model").alias("model"), fill("registration", "reg").alias("registration"),
        fill("typecode", "icaotype").alias("typecode"),
        F.when(F.col("b.mil").isNotNull(), F.col("b.mil") == 1).alias("military_hint"),
        F.col("b.year").cast("int").alias("year_built"),
        F.col("b.ownop").alias("owner_operator"),
        F.col("a.icao24").isNotNull().alias("_in_csv"), F.col("b.icao").isNotNull().alias("_in_supplement"))


def build_aircraft_reference(csv_parsed: DataFrame, supplement_lines: DataFrame,
                             supplement_line: str = "line", supplement_order: str = "line_no", limit: int = 0,
                             keep: bool = False):
    """Q4: returns (reference table, one-row stats).  ``keep``: parsed and merged
    rows are written once for both; without it each computes what it needs."""
    kept = (lambda df, name: stored(df, f"reference-{name}")) if keep else lambda df, _: df
    csv_norm = kept(apply_import_limit(normalise_csv(csv_parsed), limit), "csv")
    csv_rows = last_row_per_key(csv_norm.where(~F.col("_skipped")).drop("_skipped"), "icao24")
    sup = kept(parse_supplement(supplement_lines, supplement_line, supplement_order), "supplement")
    sup_ok = last_row_per_key(sup.where(F.col("_status") == "ok").drop("_status"), "icao")
    merged = kept(merge_reference(csv_rows, sup_ok), "merged")
    table = merged.drop("_in_csv", "_in_supplement")
    csv_stats = csv_norm.agg(F.count_if(~F.col("_skipped")).alias("csv_imported"),
                             F.count_if(F.col("_skipped")).alias("csv_skipped"))
    sup_stats = sup.agg(F.count_if(F.col("_status") == "ok").alias("basic_imported"),
                        F.count_if(F.col("_status") == "bad_json").alias("basic_skipped_json"),
                        F.count_if(F.col("_status") == "bad_icao").alias("basic_skipped_icao"))
    m_stats = merged.agg(F.count_if("_in_csv").alias("rows_before"),
                         F.count_if(F.col("_in_csv") & F.col("_in_supplement")).alias("overlap_before"),
                         F.count(F.lit(1)).alias("rows_after"),
                         F.count_if(F.coalesce(F.col("military_hint"), F.lit(False))).alias("military_true_total"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    stats = (one(csv_stats).join(one(sup_stats), "_one").join(one(m_stats), "_one")
             .withColumn("rows_added", F.col("rows_after") - F.col("rows_before")).drop("_one"))
    return table, stats


def write_aircraft_reference(table: DataFrame, stats: DataFrame, path: str, version: str) -> str:
    """K3: versioned artifact ``{path}/version={v}`` sorted by icao24, plus its
    row statistics next to it.  Existing versions are never overwritten."""
    target = f"{path.rstrip('/')}/version={version}"
    table.repartitionByRange("icao24").sortWithinPartitions("icao24").write.mode("errorifexists").parquet(
        target + "/aircraft")
    stats.coalesce(1).write.mode("errorifexists").json(target + "/stats")
    return target

