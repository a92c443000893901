"""Landed JSON documents as DataFrames of records.

A landing directory holds the documents as fetched:

    bootstrap.json               {"elements": [...], "teams": [...], "events": [...]}
    fixtures.json                [...]
    element-summary/<id>.json    {"history": [...]}
    event/<id>.json              {"elements": [...]}

Every file is parsed by the task that reads it; thousands of player files are one
distributed scan. Records are first cut out as raw JSON text, which is kept as
``raw_payload``, and then parsed with a declared schema.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT = "document"
PATH = "source_path"
POS = "pos"
RAW = "raw_payload"

WHOLE = None  # the document itself is the array of records


def read_documents(spark: SparkSession, path: str, line_delimited: bool = False) -> DataFrame:
    """Documents under a path: ``(document, source_path)``. With ``line_delimited``
    every line is a document, so one large file is read by many tasks."""
    lines = spark.read.text(path, wholetext=not line_delimited)
    return lines.select(F.col("value").alias(DOCUMENT), F.col("_metadata.file_path").alias(PATH))


def with_path_key(documents: DataFrame, name: str) -> DataFrame:
    """Add the number in the file name (a player or gameweek id) as a column."""
    key = F.regexp_extract(PATH, r"(\d+)(?:\.[A-Za-z]+)*$", 1)
    return documents.withColumn(name, key.cast("bigint"))


CORRUPT = "__corrupt"
REASON = "reason"
RECORD = "__record"
REJECTED = (PATH, POS, REASON, RAW)

# Why a document or a record was not accepted.
NOT_JSON = "not a JSON document"
NO_ARRAY = "no array of records"
NO_RECORD = "null record"
NOT_THE_SCHEMA = "record does not fit the schema"


def _parsed_document(field: str | None) -> tuple[Column, Column]:
    """The records as an array of JSON texts, and why there is none: one parse of the document."""
    if field is WHOLE:
        array = F.when(F.ltrim(DOCUMENT).startswith("["), F.from_json(DOCUMENT, "array<string>"))
        return array, F.when(~F.ltrim(DOCUMENT).startswith("["), NO_ARRAY).otherwise(NOT_JSON)
    fields = [T.StructField(field, T.ArrayType(T.StringType())), T.StructField(CORRUPT, T.StringType())]
    parsed = F.from_json(DOCUMENT, T.StructType(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return F.when(parsed[CORRUPT].isNull(), parsed[field]), F.when(parsed[CORRUPT].isNotNull(), NOT_JSON).otherwise(NO_ARRAY)


def _record_array(field: str | None) -> Column:
    """The records as an array of JSON texts; NULL if the document is not valid JSON
    or does not hold the array."""
    return _parsed_document(field)[0]


def malformed_documents(documents: DataFrame, field: str | None) -> DataFrame:
    """The documents that are not JSON or lack the array of records."""
    return documents.filter(_record_array(field).isNull())


def records(documents: DataFrame, field: str | None, keep: tuple[str, ...] = (), mode: str = "failfast") -> DataFrame:
    """One row per record: ``(*keep, pos, raw_payload)``, in document order.

    ``failfast`` fails the job on a malformed document; ``quarantine`` leaves it
    out, to be read with :func:`malformed_documents` or, with the records that do not fit, :func:`sorted_out`."""
    if mode not in ("failfast", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    array = _record_array(field)
    if mode == "failfast":
        problem = F.raise_error(F.concat(F.lit("malformed JSON document: "), F.coalesce(F.col(PATH), F.lit("?"))))
        array = F.coalesce(array, problem)
    return documents.select(*keep, F.posexplode(array).alias(POS, RAW))


def typed(rows: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse ``raw_payload``: ``(*keep, declared fields, raw_payload)``. Fields
    outside the schema, nulls included, survive in the payload."""
    parsed = F.from_json(RAW, schema, {"mode": "FAILFAST"})
    return rows.select(*keep, parsed.alias(RECORD), RAW).select(*keep, f"{RECORD}.*", RAW)


def raw_records(documents: DataFrame, field: str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, source_path, pos, raw_payload, reason)``: one row per record, and one per document that has no records.

    The reason is NULL for records; a rejected document has no position and its own text as payload. An empty array has no rows."""
    array, reason = _parsed_document(field)
    parsed = documents.select(*keep, PATH, DOCUMENT, array.alias("__records"), reason.alias(REASON))
    exploded = parsed.select(*keep, PATH, DOCUMENT, REASON, F.col("__records").isNull().alias("__bad"),
                             F.posexplode_outer("__records").alias(POS, RAW))
    return exploded.filter(F.col("__bad") | F.col(POS).isNotNull()).select(
        *keep, PATH, POS, F.when(F.col("__bad"), F.col(DOCUMENT)).otherwise(F.col(RAW)).alias(RAW),
        F.when(F.col("__bad"), F.col(REASON)).alias(REASON))


def sorted_out(raw: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of :func:`raw_records` with their parsed record: ``(*keep, source_path, pos, raw_payload, reason, __record)``.

    Each record is parsed once; those that are null or do not fit the schema get a reason. Stage this table, and both
    :func:`accepted` and :func:`rejected` read it without parsing again."""
    fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parse = F.from_json(RAW, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = raw.withColumn(RECORD, F.when(F.col(REASON).isNull(), parse))
    reason = F.when(F.col(REASON).isNotNull(), F.col(REASON)).when(F.col(RAW).isNull() | (F.trim(RAW) == "null"), NO_RECORD).when(
        F.col(f"{RECORD}.{CORRUPT}").isNotNull() | F.col(RECORD).isNull(), NOT_THE_SCHEMA)
    record = F.struct(*[F.col(f"{RECORD}.`{f.name}`").alias(f.name) for f in schema.fields]).alias(RECORD)
    return parsed.select(*keep, PATH, POS, RAW, reason.alias(REASON), record)


def accepted(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records of :func:`sorted_out` in the layout of :func:`typed`."""
    return parsed.filter(F.col(REASON).isNull()).select(*keep, f"{RECORD}.*", RAW)


def rejected(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What :func:`sorted_out` did not accept: ``(*keep, source_path, pos, reason, raw_payload)``."""
    return parsed.filter(F.col(REASON).isNotNull()).select(*keep, *REJECTED)


ELEMENT = "[]"


def _kinds_of(value, path: tuple[str, ...], seen: Counter) -> None:
    """Count the type of a JSON value, and of all it holds, under their key paths."""
    if isinstance(value, dict):
        seen[path, "object"] += 1
        for name, inner in value.items():
            _kinds_of(inner, (*path, name), seen)
    elif isinstance(value, list):
        seen[path, "array"] += 1
        for inner in value:
            _kinds_of(inner, (*path, ELEMENT), seen)
    elif value is None:
        seen[path, "null"] += 1
    elif isinstance(value, bool):
        seen[path, "boolean"] += 1
    elif isinstance(value, str):
        seen[path, "string"] += 1
    else:
        seen[path, "bigint" if isinstance(value, int) and -2**63 <= value < 2**63 else "double"] += 1


def observed_types(rows: DataFrame, column: str = RAW) -> DataFrame:
    """``(path, type, n)``: how often each JSON type stands under each key path of the payloads, paths seen only as null included.

    ``path`` is an array of keys, with ``[]`` for the elements of an array and empty for the payload itself; type is object, array,
    null, boolean, bigint, double or string. Payloads that are NULL or no JSON have type invalid at the empty path. Every batch is
    counted where it is read; what is shuffled grows with the number of paths, not of records."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                try:
                    _kinds_of(json.loads(text), (), seen)
                except (TypeError, ValueError):
                    seen[(), "invalid"] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(p) for p, _ in seen], pa.list_(pa.string())), pa.array([t for _, t in seen], pa.string()),
                 pa.array(seen.values(), pa.int64())], names=["path", "type", "n"])

    counted = rows.select(F.col(column).cast("string")).mapInArrow(count, "path array<string>, type string, n bigint")
    return counted.groupBy("path", "type").agg(F.sum("n").alias("n"))


def merged_type(path: tuple[str, ...], types: Mapping[tuple[str, ...], set[str]]) -> T.DataType:
    """The least type that holds all seen under a path: null < anything, bigint < double, all else < string."""
    seen = types.get(path, set()) - {"null", "invalid"}
    if not seen:
        return T.NullType()
    if seen == {"object"}:
        names = sorted({p[len(path)] for p in types if len(p) > len(path) and p[:len(path)] == path})
        fields = [T.StructField(name, merged_type((*path, name), types)) for name in names]
        return T.StructType(fields) if fields else T.StringType()
    if seen == {"array"}:
        return T.ArrayType(merged_type((*path, ELEMENT), types))
    if seen <= {"bigint", "double"}:
        return T.DoubleType() if "double" in seen else T.LongType()
    return T.BooleanType() if seen == {"boolean"} else T.StringType()


def infer_schema(rows: DataFrame) -> T.StructType:
    """Merged schema of the payloads, by one distributed aggregate.

    Fractional numbers are read as double, fields of mixed types as text, and
    fields that are always null keep the null type (see
    :func:`matchday.sources.frames.drop_null_type_columns`)."""
    types: dict[tuple[str, ...], set[str]] = {}
    for r in observed_types(rows).collect():  # one row per key path and type: the size of the schema
        types.setdefault(tuple(r["path"]), set()).add(r["type"])
    whole = merged_type((), types)
    return whole if isinstance(whole, T.StructType) else T.StructType([])


def complete_schema(declared: T.StructType, inferred: T.StructType, taken: Sequence[str] = ()) -> T.StructType:
    """The declared fields followed by the extra ones found in the payloads, except
    names that are ``taken`` by other columns."""
    known = {name.lower() for name in (*declared.names, *taken)}
    extra = [f for f in inferred.fields if f.name.lower() not in known]
    return T.StructType([*declared.fields, *extra])


def stamp(df: DataFrame, run_ts: Column) -> DataFrame:
    """Add the ingestion time, the same for every table of a run."""
    return df.withColumn("ingestion_ts", run_ts)
