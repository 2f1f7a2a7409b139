"""Load-time normalisation of raw flows and of knowledge-base records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgraph.schemas import (
    COUNTER_COLUMNS, FLAG_COLUMNS, NETWORK_LOG_COLUMNS, PORT_COLUMNS, REAL_COLUMNS, TEXT_COLUMNS, TIME_COLUMN,
)

_ZONED = r"\d{2}:\d{2}.*(Z|z|[+-]\d{2}:?\d{2})$"


def add_missing_columns(df: DataFrame) -> DataFrame:
    """Give every absent raw column its typed default."""
    defaults = {
        **{c: F.lit(False) for c in FLAG_COLUMNS},
        **{c: F.lit(0).cast("long") for c in COUNTER_COLUMNS + PORT_COLUMNS},
        **{c: F.lit(0.0) for c in REAL_COLUMNS},
        TIME_COLUMN: F.lit(None).cast("timestamp_ntz"),
        **{c: F.lit("") for c in TEXT_COLUMNS},
    }
    return df.withColumns({c: defaults[c] for c in NETWORK_LOG_COLUMNS if c not in df.columns})


def to_real(c: Column, dtype: T.DataType) -> Column:
    """Double; unreadable, NULL and NaN become 0."""
    number = c.cast("int") if isinstance(dtype, T.BooleanType) else c
    return F.nanvl(F.coalesce(number.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def to_integer(c: Column, dtype: T.DataType, target: str = "long") -> Column:
    """Integer, truncated toward zero; unreadable or NULL becomes 0."""
    if isinstance(dtype, T.IntegralType):
        return F.coalesce(c.try_cast(target), F.lit(0).cast(target))
    return F.coalesce(to_real(c, dtype).try_cast(target), F.lit(0).cast(target))


def to_flag(c: Column, dtype: T.DataType) -> Column:
    """0 or 1; numbers are clipped, anything unreadable is 0."""
    return F.least(F.greatest(to_real(c, dtype), F.lit(0.0)), F.lit(1.0)).cast("tinyint")


def strip_zone(ts: Column) -> Column:
    """Zone-less UTC time of an instant; through the epoch, so that the session zone plays no part."""
    micros = F.unix_micros(ts)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(micros / 86_400_000_000).cast("int"), F.lit(0), F.lit(0),
        (F.pmod(micros, F.lit(86_400_000_000)) / 1_000_000).cast("decimal(18,6)"),
    )


def to_utc(c: Column, dtype: T.DataType) -> Column:
    """Zone-less UTC time in milliseconds; what cannot be read becomes 1970-01-01."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")

    if isinstance(dtype, T.TimestampNTZType):
        time = c
    elif isinstance(dtype, T.TimestampType):
        time = strip_zone(c)
    elif isinstance(dtype, T.DateType):
        time = c.cast("timestamp_ntz")
    else:
        text = c.cast("string")
        time = F.when(text.rlike(_ZONED), strip_zone(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))
    below_ms = F.pmod((F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("long"), F.lit(1000))
    exact = time - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (below_ms / 1_000_000).cast("decimal(18,6)"))
    return F.coalesce(exact, epoch)


def to_text(c: Column, dtype: T.DataType, null_text: str | None) -> Column:
    """Text; ``nan`` becomes empty and NULL becomes ``null_text`` (None keeps NULL)."""
    text = c.cast("string")
    gap = text == "nan"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        gap = gap | F.isnan(c)
    text = F.when(gap, F.lit("")).otherwise(text)
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def load_normalize(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Raw flows as the typed 28-column table.

    ``null_text="None"`` writes a missing text as the word None, which staging then reads as a
    tactic (Attack) and as a non-duplicate; the default keeps it NULL (Normal; dropped by the
    duplicate filter when ``label_binary`` is NULL).
    """
    df = add_missing_columns(df)
    kind = {f.name: f.dataType for f in df.schema}
    out = {}
    for c in FLAG_COLUMNS:
        out[c] = to_flag(F.col(c), kind[c])
    for c in COUNTER_COLUMNS:
        out[c] = to_integer(F.col(c), kind[c])
    for c in PORT_COLUMNS:
        out[c] = to_integer(F.col(c), kind[c], "int")
    for c in REAL_COLUMNS:
        out[c] = to_real(F.col(c), kind[c])
    out[TIME_COLUMN] = to_utc(F.col(TIME_COLUMN), kind[TIME_COLUMN])
    for c in TEXT_COLUMNS:
        out[c] = to_text(F.col(c), kind[c], null_text)
    return df.select(*[out[c].alias(c) for c in NETWORK_LOG_COLUMNS])


def clean_cves(df: DataFrame) -> DataFrame:
    """CVE records without gaps: severity 0.0, year 2026, empty description."""
    return df.withColumns(
        {
            "severity_score": F.coalesce(F.col("severity_score").cast("double"), F.lit(0.0)),
            "year": F.coalesce(F.col("year").cast("int"), F.lit(2026)),
            "description": F.coalesce(F.col("description").cast("string"), F.lit("")),
        }
    )


def metadata_text(c: Column, n: int) -> Column:
    """The first ``n`` characters, a short form for display beside the whole text."""
    return F.substring(c, 1, n)
