"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ColumnLike = Column | str | int | float | bool


def as_col(value: ColumnLike) -> Column:
    """A string names a column; any other plain value is a literal."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def settle(value: ColumnLike, digits: int = 4) -> Column:
    """Round at a point no short decimal falls on.

    Sums of doubles depend on the order of addition, and a mean such as x.xxxx5
    then rounds up or down by chance. Moving the cut off the tie makes the
    result repeatable across partition counts and engines.
    """
    scale = float(10 ** digits)
    return F.floor(as_col(value) * F.lit(scale) + F.lit(0.50012345)) / F.lit(scale)


def utc_instant(wall: ColumnLike) -> Column:
    """Instant of a zoneless time that is meant as UTC, whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), as_col(wall)).cast("timestamp")


def utc_wall(instant: ColumnLike) -> Column:
    """Zoneless UTC time of an instant, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), as_col(instant).cast("timestamp_ntz"))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A fixed lookup table as a local relation, whose size the optimizer knows."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
