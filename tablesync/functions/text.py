"""Value/list -> text with Python's ``str`` spelling for NULL and booleans."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

# List separator and the spellings of NULL / booleans.
LIST_SEPARATOR = ", "
NULL_TEXT = "None"
TRUE_TEXT = "True"
FALSE_TEXT = "False"
SMALLEST_NORMAL = 2.2250738585072014e-308


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it (through a lambda) several times."""
    return F.get(F.transform(F.array(value), body), 0)


@arrow_udf(T.StringType())
def _python_text(values: pa.Array) -> pa.Array:
    """Python's ``str`` of numbers; lists are joined recursively."""

    def text(v) -> str:
        return LIST_SEPARATOR.join(map(text, v)) if isinstance(v, list) else str(v)

    return pa.array([None if v is None else text(v) for v in values.to_pylist()], pa.string())


def _python_layout(d: Column, e: Column) -> Column:
    """Python's layout of digits ``d`` (no leading/trailing zeros) times
    ``10**e`` (``e`` = exponent of the first digit)."""
    n = F.length(d)
    fixed_pos = F.concat(
        F.substring(F.rpad(d, F.greatest(n, e + 1), "0"), F.lit(1), e + 1),
        F.lit("."),
        F.when(n > e + 1, F.substring(d, e + 2, F.lit(64))).otherwise(F.lit("0")),
    )
    fixed_neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), d)
    rest = F.substring(d, F.lit(2), F.lit(64))
    mag = F.abs(e).cast("string")
    scientific = F.concat(
        F.substring(d, 1, 1),
        F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(F.lit("")),
        F.lit("e"),
        F.when(e < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.length(mag) < 2, F.concat(F.lit("0"), mag)).otherwise(mag),
    )
    return F.when((e >= -4) & (e < 16), F.when(e >= 0, fixed_pos).otherwise(fixed_neg)).otherwise(scientific)


def _jvm_digits(t: Column) -> Column:
    """(digits without zeros at the ends, exponent of the first) of the JVM's text of a double."""
    has_e = F.instr(t, "E") > 0
    mant = F.when(has_e, F.substring_index(t, "E", 1)).otherwise(t)
    jexp = F.when(has_e, F.substring_index(t, "E", -1).cast("int")).otherwise(F.lit(0))
    whole = F.substring_index(mant, ".", 1)
    raw = F.concat(whole, F.substring_index(mant, ".", -1))
    lead = F.length(raw) - F.length(F.regexp_replace(raw, "^0+", ""))
    digits = F.regexp_replace(F.regexp_replace(raw, "^0+", ""), "0+$", "")
    return F.struct(digits.alias("d"), (jexp + F.length(whole) - 1 - lead).alias("e"))


def python_float_text(x: Column) -> Column:
    """A double spelled as Python's ``str`` does (``1e+16``, ``10000000.0``,
    ``1e-05``, ``nan``, ``inf``).

    The JVM's text is not always the shortest.  Where it has at most 15 digits and the
    number is normal, it is: no two decimals of so few digits read as one double.  Those
    values are laid out JVM-side; only the others travel to Python (as in
    :func:`~tablesync.functions.names.strip_accents`, the rest goes as NULLs).
    """
    jtext = F.regexp_replace(x.cast("string"), "^-", "")
    few = (F.length(_jvm_digits(jtext)["d"]) <= 15) & (F.abs(x) >= SMALLEST_NORMAL)
    laid_out = _let(_let(jtext, _jvm_digits), lambda r: _python_layout(r["d"], r["e"]))
    spelled = F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), laid_out)
    plain = F.isnan(x) | (x == 0) | (F.abs(x) == F.lit(float("inf")))
    exact = _python_text(F.when(x.isNotNull() & ~plain & ~few, x))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("nan"))
        .when(x == F.lit(float("inf")), F.lit("inf"))
        .when(x == F.lit(float("-inf")), F.lit("-inf"))
        .when(x == 0, x.cast("string"))
        .otherwise(F.coalesce(exact, spelled))
    )


def _holds_floats(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType)) or isinstance(dtype, T.ArrayType) and _holds_floats(dtype.elementType)


def value_text(col: Column, dtype: T.DataType) -> Column:
    """Text of one value; arrays are joined recursively with ``", "``."""
    if isinstance(dtype, T.ArrayType) and _holds_floats(dtype):
        return F.coalesce(_python_text(col), F.lit(NULL_TEXT))  # Python does not run inside array functions
    if isinstance(dtype, T.ArrayType):
        inner = dtype.elementType
        joined = F.array_join(F.transform(col, lambda x: value_text(x, inner)), LIST_SEPARATOR)
        return F.coalesce(joined, F.lit(NULL_TEXT))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.coalesce(python_float_text(col.cast("double")), F.lit(NULL_TEXT))
    if isinstance(dtype, T.BooleanType):
        return F.when(col.isNull(), F.lit(NULL_TEXT)).when(col, F.lit(TRUE_TEXT)).otherwise(F.lit(FALSE_TEXT))
    return F.coalesce(col.cast(T.StringType()), F.lit(NULL_TEXT))


def array_to_text(df, column: str, alias: str | None = None) -> Column:
    """Column expression turning ``df[column]`` (any type) into text."""
    dtype = df.schema[column].dataType
    return value_text(F.col(column), dtype).alias(alias or column)
