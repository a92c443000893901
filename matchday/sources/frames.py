"""Helpers for DataFrames whose schema was inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchday.functions.scalars import to_payload
from matchday.sources.landing import RAW


def contains_null_type(data_type: T.DataType) -> bool:
    """True if the type is, or holds at any depth, the null type."""
    if isinstance(data_type, T.StructType):
        children: Sequence[T.DataType] = [f.dataType for f in data_type.fields]
    elif isinstance(data_type, T.ArrayType):
        children = [data_type.elementType]
    elif isinstance(data_type, T.MapType):
        children = [data_type.keyType, data_type.valueType]
    else:
        children = []
    return isinstance(data_type, T.NullType) or any(map(contains_null_type, children))


def drop_null_type_columns(df: DataFrame) -> DataFrame:
    """Drop columns that cannot be stored because no value gave them a type."""
    return df.drop(*[f.name for f in df.schema.fields if contains_null_type(f.dataType)])


def with_payload(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add ``raw_payload``, the JSON text of the row, for rows without landed text."""
    return df.withColumn(RAW, to_payload(*(columns or df.columns)))


def single_row(spark: SparkSession, record: Mapping[str, Any], schema: T.StructType) -> DataFrame:
    """A one-row DataFrame, such as a log entry."""
    return spark.createDataFrame([tuple(record.get(name) for name in schema.names)], schema)
