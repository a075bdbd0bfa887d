"""Aircraft photo records (N18, N19) over stored lookup responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.expr import photo_status_from_http, trim_to_null
from skyfold.operators.sequence import materialize

# Fixed values -------------------------------------------------------------
TRUSTED_HOSTS = ["t.plnspttrs.net", "cdn.planespotters.net", "www.planespotters.net", "planespotters.net"]
# --------------------------------------------------------------------------

_NUMERIC = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def _get(path: str, typ: str = "string") -> Column:
    return F.expr(f"try_variant_get(_v, '{path}', '{typ}')")


def _type(path: str) -> Column:
    return F.expr(f"schema_of_variant(try_variant_get(_v, '{path}'))")


def _int(path: str) -> Column:
    t = _type(path)
    numeric = t.isin(*_NUMERIC) | t.startswith("DECIMAL")
    return F.when(numeric, _get(path, "double").cast("int"))


def parse_photo_payloads(payloads: DataFrame, body: str = "body", http_status: str = "http_status") -> DataFrame:
    """N19 + N18: status from the HTTP code; a 2xx body is parsed: a textual
    ``error`` -> error; no photos -> not_found; the first photo needs https
    thumbnail, large thumbnail and link on trusted hosts, else error; sizes
    only when numeric."""
    d = materialize(payloads, _v=F.expr(f"try_parse_json({body})"))
    urls = {}
    for name, path in (("thumb", "$.photos[0].thumbnail.src"), ("large", "$.photos[0].thumbnail_large.src"),
                       ("link", "$.photos[0].link")):
        d = d.withColumn("_u", trim_to_null(_get(path)))
        ok = (F.lower(F.expr("try_parse_url(_u, 'PROTOCOL')")) == "https") & \
            F.lower(F.expr("try_parse_url(_u, 'HOST')")).isin(*TRUSTED_HOSTS)
        d = d.withColumn("_" + name, F.when(F.coalesce(ok, F.lit(False)), F.col("_u")))
        urls[name] = F.col("_" + name)
    http = photo_status_from_http(http_status)
    n_photos = F.size(_get("$.photos", "array<variant>"))
    parsed_status = (F.when(F.col("_v").isNull(), "error")
                     .when(_type("$.error") == "STRING", "error")
                     .when(F.coalesce(n_photos, F.lit(-1)) <= 0, "not_found")
                     .when(urls["thumb"].isNull() | urls["large"].isNull() | urls["link"].isNull(), "error")
                     .otherwise("available"))
    status = F.coalesce(http, parsed_status)
    avail = status == "available"
    keep = lambda c: F.when(avail, c)
    photographer = trim_to_null(_get("$.photos[0].photographer"))
    out = d.select(
        *[c for c in payloads.columns if c != body], status.alias("status"),
        keep(urls["thumb"]).alias("thumbnail_url"), keep(_int("$.photos[0].thumbnail.size.width")).alias("thumbnail_width"),
        keep(_int("$.photos[0].thumbnail.size.height")).alias("thumbnail_height"),
        keep(urls["large"]).alias("large_thumbnail_url"),
        keep(_int("$.photos[0].thumbnail_large.size.width")).alias("large_width"),
        keep(_int("$.photos[0].thumbnail_large.size.height")).alias("large_height"),
        keep(photographer).alias("photographer"), keep(urls["link"]).alias("source_link"))
    return out


PHOTO_COLUMNS = ["status", "thumbnail_url", "thumbnail_width", "thumbnail_height", "large_thumbnail_url",
                 "large_width", "large_height", "photographer", "source_link"]


def as_photo_struct(parsed: DataFrame) -> DataFrame:
    """Pack the photo columns into the ``photo`` struct."""
    keep = [c for c in parsed.columns if c not in PHOTO_COLUMNS]
    return parsed.select(*keep, F.struct(*PHOTO_COLUMNS).alias("photo"))

