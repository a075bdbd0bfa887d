"""Aircraft taxonomy CASE trees (X1–X4).  Pure column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfold.functions.expr import col_of, norm_optional, trim_to_null

__all__ = ["airframe_type", "fleet_type", "aircraft_size", "aircraft_type_label",
           "FLEET_ORDER", "SIZE_ORDER", "normalized_columns"]

# Fixed values -------------------------------------------------------------
HELICOPTER_CATEGORY_WORDS = ["heli", "rotor"]
HELICOPTER_CATEGORY_PATTERN = r"^h\d.*"
HELICOPTER_TYPECODE_PREFIXES = ["H", "EC", "AS", "SA", "AW", "BK", "MI", "KA", "UH", "CH"]
RESCUE_OWNER_WORDS = ["samu", "secours", "rescue", "hems", "medevac", "civil security", "civil protection"]
RESCUE_CATEGORY_WORDS = ["rescue", "secours", "hems", "medevac", "medical", "ambulance"]
RESCUE_CALLSIGN_WORDS = ["samu", "rescue", "dragon", "hems", "lifeguard", "secours"]
PRIVATE_OWNER_WORDS = ["private", "charter"]
PRIVATE_CATEGORY_WORDS = ["private", "business", "general"]
HEAVY_CATEGORY_WORDS = ["heavy"]
LARGE_CATEGORY_WORDS = ["large", "wide"]
SMALL_CATEGORY_WORDS = ["light", "small", "ultra"]
HEAVY_TYPECODE_PREFIXES = ["B74", "B77", "A38"]
LARGE_TYPECODE_PREFIXES = ["A3", "B7", "B8"]
SMALL_TYPECODE_PREFIXES = ["C1", "P", "E", "H"]
FLEET_ORDER = ["commercial", "military", "rescue", "private", "unknown"]
SIZE_ORDER = ["small", "medium", "large", "heavy", "unknown"]
# --------------------------------------------------------------------------


def _contains_any(c: Column, words) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | c.contains(w)
    return F.coalesce(cond, F.lit(False))


def _starts_any(c: Column, prefixes) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | c.startswith(p)
    return F.coalesce(cond, F.lit(False))


def _norm(c, case, normalized):
    return col_of(c) if normalized else norm_optional(c, case)


def normalized_columns(df, category="category", typecode="typecode", owner="owner_operator",
                       callsign="callsign"):
    """Add ``_cat``/``_tc``/``_own``/``_cs``: normalised once so the CASE trees
    below stay small enough for whole-stage codegen."""
    return df.select("*", norm_optional(category, "lower").alias("_cat"),
                     norm_optional(typecode, "upper").alias("_tc"),
                     norm_optional(owner, "lower").alias("_own"),
                     norm_optional(callsign, "lower").alias("_cs"))


def airframe_type(category="category_description", typecode="typecode", normalized=False) -> Column:
    """``helicopter`` / ``airplane`` / null."""
    cat = _norm(category, "lower", normalized)
    tc = _norm(typecode, "upper", normalized)
    heli = (_contains_any(cat, HELICOPTER_CATEGORY_WORDS)
            | F.coalesce(cat.rlike(HELICOPTER_CATEGORY_PATTERN), F.lit(False))
            | _starts_any(tc, HELICOPTER_TYPECODE_PREFIXES))
    return (F.when(heli, F.lit("helicopter"))
            .when(cat.isNotNull() | tc.isNotNull(), F.lit("airplane")))


def fleet_type(military_hint="military_hint", callsign="callsign",
               category="category_description", owner="owner_operator", normalized=False) -> Column:
    """Military -> rescue -> private -> unknown (no category) -> commercial."""
    cs = _norm(callsign, "lower", normalized)
    own = _norm(owner, "lower", normalized)
    cat = _norm(category, "lower", normalized)
    rescue = (_contains_any(own, RESCUE_OWNER_WORDS)
              | _contains_any(cat, RESCUE_CATEGORY_WORDS)
              | _contains_any(cs, RESCUE_CALLSIGN_WORDS))
    private = _contains_any(own, PRIVATE_OWNER_WORDS) | _contains_any(cat, PRIVATE_CATEGORY_WORDS)
    return (F.when(F.coalesce(col_of(military_hint), F.lit(False)), F.lit("military"))
            .when(rescue, F.lit("rescue"))
            .when(private, F.lit("private"))
            .when(cat.isNull(), F.lit("unknown"))
            .otherwise(F.lit("commercial")))


def aircraft_size(category="category_description", typecode="typecode", normalized=False) -> Column:
    """Size from category words first, then typecode prefixes."""
    cat = _norm(category, "lower", normalized)
    tc = _norm(typecode, "upper", normalized)
    return (F.when(_contains_any(cat, HEAVY_CATEGORY_WORDS), F.lit("heavy"))
            .when(_contains_any(cat, LARGE_CATEGORY_WORDS), F.lit("large"))
            .when(_contains_any(cat, SMALL_CATEGORY_WORDS), F.lit("small"))
            .when(tc.isNull(), F.lit("unknown"))
            .when(_starts_any(tc, HEAVY_TYPECODE_PREFIXES), F.lit("heavy"))
            .when(_starts_any(tc, LARGE_TYPECODE_PREFIXES), F.lit("large"))
            .when(_starts_any(tc, SMALL_TYPECODE_PREFIXES), F.lit("small"))
            .otherwise(F.lit("medium")))


def aircraft_type_label(category="category_description", typecode="typecode") -> Column:
    """Typecode, else category, else ``unknown`` (values kept as stored)."""
    tc, cat = col_of(typecode), col_of(category)
    return (F.when(trim_to_null(tc).isNotNull(), tc)
            .when(trim_to_null(cat).isNotNull(), cat)
            .otherwise(F.lit("unknown")))
