"""Column expressions (JVM-side, code-generated) used by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import col


def finite_double(name: str) -> Column:
    """P5: the value as a double; a value that is not a finite number fails the job.

    Numbers, booleans, decimals and numeric text convert (``try_cast`` trims
    blanks and accepts ``inf``), then anything that came out null, NaN or
    infinite raises through ``raise_error`` while the rows stream by, so no
    separate validation pass over the data is needed. Nulls in the input must
    have been dropped beforehand (P4), as the reference's diagrams do.
    """
    raw = col(name)
    as_double = F.expr(f"try_cast({_sql_name(name)} AS DOUBLE)")
    bad = (
        as_double.isNull()
        | F.isnan(as_double)
        | (F.abs(as_double) == F.lit(float("inf")))
    )
    message = F.concat(
        F.lit(f"column {name!r} must hold finite numbers, got: "),
        F.coalesce(raw.cast("string"), F.lit("null")),
    )
    return F.when(bad, F.raise_error(message)).otherwise(as_double)


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cell_text(name: str, data_type: T.DataType) -> Column:
    """Printable text of one cell; null prints as the empty string.

    Nested values (struct, array, map) become JSON text with null fields kept.
    """
    value = col(name)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(value, {"ignoreNullFields": "false"})
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def md5_leading_digits(expr: Column, hex_digits: int = 8) -> Column:
    """The leading ``hex_digits`` of the md5 digest of the whole text, as a number."""
    return F.conv(F.substring(F.md5(expr.cast("string")), 1, hex_digits), 16, 10).cast(
        "decimal(38,0)"
    )
