"""Streaming prompt datasets: only the stateless format mapping applies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from prefspark.operators.prompts import prepare_prompts


def read_prompts_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "json",
    dataset_format: str = "prompt",
    max_files_per_trigger: int | None = None,
    **columns,
) -> DataFrame:
    """Stream a prompt dataset with a declared schema and map it to ``prompt``.

    Limit, shuffle and split do not apply to an unbounded stream.
    """
    reader = spark.readStream.schema(schema).format(format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return prepare_prompts(reader.load(path), dataset_format, **columns)
