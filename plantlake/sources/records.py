"""JSON records: decoding to typed columns and encoding with a key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from plantlake.schema import struct


def decode_json(df: DataFrame, column: str, schema: str | T.StructType, lenient: bool = False,
                keep: tuple[str, ...] = (), rescued: str | None = None) -> DataFrame:
    """Typed columns from a JSON text or binary column.

    Strict decoding parses a record once; a value of the wrong JSON type is null.
    Lenient decoding reads each field as text and casts it, so a quoted number
    still becomes a number. A malformed record gives nulls in both.

    ``rescued`` names a column for the raw text of records that are no JSON object or have a value that does not fit its
    type; it is null for all others, also for null records. Strictly decoded, such a record has null fields only; leniently
    decoded, it keeps those that fit.
    """
    fields = (struct(schema) if isinstance(schema, str) else schema).fields
    text = F.col(column).cast("string")
    if rescued:
        return _rescuing(df.select(*keep, text.alias("__text")), fields, lenient, keep, rescued)
    if lenient:
        raw = [f"__{f.name}" for f in fields]  # one parse for all fields
        texts = df.select(*keep, F.json_tuple(text, *[f.name for f in fields]).alias(*raw))
        return texts.select(*keep, *[F.col(r).try_cast(f.dataType).alias(f.name) for r, f in zip(raw, fields)])
    parsed = df.select(*keep, F.from_json(text, T.StructType(fields)).alias("__r"))
    return parsed.select(*keep, *[F.col(f"__r.{f.name}").alias(f.name) for f in fields])


def _rescuing(df: DataFrame, fields: list[T.StructField], lenient: bool, keep: tuple[str, ...], rescued: str) -> DataFrame:
    names = [f.name for f in fields]
    if lenient:
        raw = [f"__{n}" for n in names]
        texts = df.select(*keep, "__text", F.json_tuple("__text", *names).alias(*raw))
        typed = texts.select(*keep, "__text", *raw, *[F.col(r).try_cast(f.dataType).alias(f.name) for r, f in zip(raw, fields)])
        unfit = reduce(lambda a, b: a | b, [F.col(r).isNotNull() & F.col(n).isNull() for r, n in zip(raw, names)])
        # A record is an object if it starts as one and can be parsed.
        whole = F.get_json_object("__text", "$").startswith("{")
        bad = F.col("__text").isNotNull() & (~F.coalesce(whole, F.lit(False)) | unfit)
        return typed.select(*keep, *names, F.when(bad, F.col("__text")).alias(rescued))
    shape = T.StructType([*fields, T.StructField("__bad", T.StringType())])
    parsed = df.select(*keep, "__text", F.from_json("__text", shape, {"columnNameOfCorruptRecord": "__bad"}).alias("__r"))
    bad = F.col("__r.__bad").isNotNull() | (F.col("__text").isNotNull() & F.col("__r").isNull())
    return parsed.select(*keep, *[F.when(~bad, F.col(f"__r.{n}")).alias(n) for n in names], F.when(bad, F.col("__text")).alias(rescued))


def to_records(df: DataFrame, key: str) -> DataFrame:
    """Each row as a JSON ``value`` under its ``key``, the shape broker sinks take. Times keep their microseconds."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    value = F.to_json(F.struct("*"), {"timestampNTZFormat": micros, "timestampFormat": f"{micros}XXX"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))
