"""Order lines as they arrive, brought to the declared staging schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DELIVERY_RAW

_NUMBERS = (T.IntegralType, T.FractionalType)
_TIMES = (T.TimestampNTZType, T.TimestampType, T.DateType)


def _assign(value: Column, name: str, given: T.DataType, wanted: str) -> Column:
    """Assignment cast: numbers to numbers (rounding), text to text, times to times."""
    if isinstance(given, T.NullType):
        return value.cast(wanted)
    accepted = {"string": (T.StringType,), "timestamp_ntz": _TIMES}.get(wanted, _NUMBERS)
    if not isinstance(given, accepted):
        raise TypeError(f"column {name}: {given.simpleString()} cannot be stored as {wanted}")
    if wanted in ("int", "bigint"):
        # Ids arrive as doubles where a writer had no nullable integers.
        if isinstance(given, T.DecimalType):
            value = F.round(value, 0)
        elif isinstance(given, T.FractionalType):
            value = F.rint(value)
    if isinstance(given, (T.FloatType, T.DoubleType)) and wanted.startswith("decimal"):
        # A cast to decimal would turn these into NULL without a word.
        infinite = F.abs(value) == F.lit(float("inf")).cast(given)
        failed = F.raise_error(F.lit(f"column {name}: a value is not a finite number"))
        value = F.when(F.isnan(value) | infinite, failed.cast(given)).otherwise(value)
    return value.cast(wanted)


def _given(raw: DataFrame) -> dict[str, T.StructField]:
    """Fields by declared name; a column the staging table does not declare is an error."""
    given = {field.name.lower(): field for field in raw.schema.fields}
    if len(given) < len(raw.columns):
        raise ValueError(f"column names repeat: {', '.join(raw.columns)}")
    unknown = sorted(set(given) - set(DELIVERY_RAW))
    if unknown:
        raise ValueError(f"columns not in delivery_raw: {', '.join(unknown)}")
    return given


def stage(raw: DataFrame) -> DataFrame:
    """Match columns by name, cast to the declared types, fill absent columns with NULL.

    A column the staging table does not declare is an error, as is a value of another kind.
    """
    given = _given(raw)
    columns = []
    for name, kind in DELIVERY_RAW.items():
        if name in given:
            field = given[name]
            column = _assign(F.col(f"`{field.name}`"), name, field.dataType, kind)
        else:
            column = F.lit(None).cast(kind)
        columns.append(column.alias(name))
    return raw.select(*columns)


# ------------------------------------------------------------- values that cannot be staged

WRONG_KIND, NOT_A_NUMBER, NOT_A_TIME = "wrong kind", "not a number", "not a time"
NOT_FINITE, OUT_OF_RANGE = "not finite", "out of range"


def _try_assign(value: Column, given: T.DataType, wanted: str) -> tuple[Column, Column | None]:
    """The value as the declared type, NULL where it is none, and why (NULL where it is one).

    More is taken than ``_assign`` takes: text that spells a number or a time. No reason means that
    nothing can go wrong.
    """
    if isinstance(given, T.NullType) or (wanted == "string" and isinstance(given, T.StringType)):
        return value.cast(wanted), None
    if wanted == "timestamp_ntz" and isinstance(given, _TIMES):
        return value.cast(wanted), None
    if wanted == "timestamp_ntz" and isinstance(given, T.StringType):
        parsed = value.try_cast(wanted)
        return parsed, F.when(value.isNotNull() & parsed.isNull(), NOT_A_TIME)
    text = isinstance(given, T.StringType)
    if wanted in ("string", "timestamp_ntz") or not (text or isinstance(given, _NUMBERS)):
        return F.lit(None).cast(wanted), F.when(value.isNotNull(), WRONG_KIND)
    # Text is read exactly; whether it is a number at all, and a finite one, its double says.
    number = value.try_cast("decimal(38,10)") if text else value
    size = value.try_cast("double")
    if wanted in ("int", "bigint"):
        if isinstance(given, (T.FloatType, T.DoubleType)):
            number = F.rint(number)
        elif text or isinstance(given, T.DecimalType):
            number = F.round(number, 0)
    fitted = number.try_cast(wanted)
    infinite = F.isnan(size) | (F.abs(size) == F.lit(float("inf")))
    reason = F.when(value.isNull() | fitted.isNotNull(), F.lit(None))
    return fitted, reason.when(size.isNull(), NOT_A_NUMBER).when(infinite, NOT_FINITE).otherwise(
        OUT_OF_RANGE
    )


def _tried(raw: DataFrame) -> DataFrame:
    """The declared columns, NULL where a value is none, and ``rejects``: (column_name, reason)s."""
    given, columns, reasons = _given(raw), [], []
    for name, kind in DELIVERY_RAW.items():
        if name not in given:
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        column, reason = _try_assign(F.col(f"`{given[name].name}`"), given[name].dataType, kind)
        columns.append(column.alias(name))
        if reason is not None:
            reasons.append(F.struct(F.lit(name).alias("column_name"), reason.alias("reason")))
    none = F.array().cast("array<struct<column_name:string,reason:string>>")
    found = F.array(*reasons) if reasons else none
    return raw.select(*columns, F.filter(found, lambda r: r["reason"].isNotNull()).alias("rejects"))


def accepted(raw: DataFrame) -> DataFrame:
    """The staged form of the lines whose values are all of their declared types, or spell one."""
    return _tried(raw).filter(F.size("rejects") == 0).drop("rejects")


def rejected(raw: DataFrame) -> DataFrame:
    """The other lines: declared columns as far as they could be read, and why others could not."""
    return _tried(raw).filter(F.size("rejects") > 0)


def reject_counts(raw: DataFrame) -> DataFrame:
    """Lines per column and reason for which its value cannot be staged; one scan, no line is shuffled."""
    reasons = rejected(raw).select(F.inline("rejects"))
    return reasons.groupBy("column_name", "reason").agg(F.count("*").alias("rejected_rows"))
