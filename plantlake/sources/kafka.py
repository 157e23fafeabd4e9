"""Broker source. The connector jar and all connection values come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "latest",
                  security: dict[str, str] | None = None, **extra: str) -> dict[str, str]:
    """Option map for the ``kafka`` format. ``security`` keys are client settings
    without their ``kafka.`` prefix."""
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
               "startingOffsets": starting_offsets}
    options.update({f"kafka.{k}": v for k, v in (security or {}).items()})
    options.update(extra)
    return options


def kafka_source(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()
