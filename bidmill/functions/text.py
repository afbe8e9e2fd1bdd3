"""Text helpers shared by the price file and the payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMS_TYPE = T.ArrayType(T.StructType([
    T.StructField("dimension_type_id", T.IntegerType()),
    T.StructField("dimension_value", T.StringType())]))


def money_text(c) -> Column:
    """two decimals as text, Python's "%0.2f": half-even on the exact
    binary value (so 0.125 -> 0.12, 2.675 -> 2.67, 0.375 -> 0.38, -0.001 -> -0.00)."""
    return F.call_function("format_number", _col(c), F.lit("0.00"))


def money_number(c) -> Column:
    """F8: the same rounding, as a number."""
    return money_text(c).cast("double")


def number_text(c) -> Column:
    """The price file's number format: the shortest text that reads back as
    the same double."""
    return _col(c).cast("double").cast("string")


def parse_dims(text, lenient: bool = False) -> Column:
    """JSON list of {dimension_type_id, dimension_value} -> array of
    struct with an integer value; a non-number raises (``lenient`` -> NULL)."""
    arr = F.from_json(_col(text), DIMS_TYPE)
    cast = (lambda v: v.try_cast("long")) if lenient else (lambda v: v.cast("long"))
    return F.transform(arr, lambda d: F.struct(
        d["dimension_type_id"].alias("dimension_type_id"),
        cast(d["dimension_value"]).alias("dimension_value")))


def make_key(dims) -> Column:
    """TAB-join of the dimension values."""
    return F.array_join(F.transform(_col(dims), lambda d: d["dimension_value"].cast("string")), "\t")


def value_string(strategy_id, multiplier, baseline) -> Column:
    """"strategy:multiplier:baseline"."""
    return F.concat_ws(":", _col(strategy_id).cast("string"), number_text(multiplier),
                       number_text(baseline))


def compute_hash(method: str, data) -> Column:
    """F16: md5 or sha1 hex of text; any other method is an error."""
    b = _col(data).cast("binary")
    if method == "md5":
        return F.md5(b)
    if method == "sha1":
        return F.sha1(b)
    raise ValueError(f"unsupported hash method {method!r}")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
