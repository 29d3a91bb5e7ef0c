"""From JSON messages to record columns.

JSON is parsed in Spark's default PERMISSIVE mode and no row is filtered: a message that is not
valid JSON stays as a row of NULLs and is counted, a field of the wrong type is NULL on its own.
All functions serve batch and streaming DataFrames alike and add no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from fieldtally.schemas import CORE_FIELDS, SOURCES, check_source, core_schema_for, schema_for

CORE_COLUMNS = ("topic", "kingdom", "scientificName")
_CORE_STRUCT = "struct<kingdom: string, scientificName: string>"


def parse_json(df: DataFrame, schema: str | StructType, column: str = "value") -> DataFrame:
    """Replace the frame by the fields of one JSON text column."""
    return df.select(F.from_json(column, schema).alias(column)).select(f"{column}.*")


def parse_records(
    messages: DataFrame, source: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """One source's records with all their fields, or with the named ones only.

    ``messages`` holds that source's messages only.
    """
    return parse_json(messages, schema_for(source, fields))


def core_columns(records: DataFrame, source: str) -> DataFrame:
    """Full records of one source under the common names, with the source as ``topic``."""
    check_source(source)
    fields = [F.col(f"`{field}`").alias(name) for name, field in CORE_FIELDS[source].items()]
    return records.select(F.lit(source).alias("topic"), *fields)


def core_records(messages: DataFrame, topics: Sequence[str] = SOURCES) -> DataFrame:
    """``(topic, kingdom, scientificName)`` of a stream that mixes several topics.

    Each value is parsed once, by the schema of its topic, and only for the core fields. A topic
    outside ``topics`` fails the query, because there is no schema to read it by.
    """
    core = _core_by_topic(topics).alias("core")
    return messages.select("topic", core).select("topic", "core.*")


def _core_by_topic(topics: Sequence[str]) -> Column:
    if not topics:
        raise ValueError("at least one topic is needed")
    unknown = F.raise_error(F.concat(F.lit("no record schema for topic "), F.col("topic")))
    parsed = unknown.cast(_CORE_STRUCT)
    for topic in topics:
        core = F.from_json("value", core_schema_for(topic)).cast(_CORE_STRUCT)
        parsed = F.when(F.col("topic") == topic, core).otherwise(parsed)
    return parsed


def union_sources(records: Mapping[str, DataFrame]) -> DataFrame:
    """Core columns of several per-source record frames in one frame; duplicates stay."""
    cores = [core_columns(df, source) for source, df in records.items()]
    if not cores:
        raise ValueError("at least one source is needed")
    return reduce(DataFrame.unionByName, cores)
