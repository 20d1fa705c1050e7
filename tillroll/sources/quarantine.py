"""Readers that keep malformed records apart instead of losing them.

CSV and JSON are parsed permissively with a schema. A record that does not fit
keeps the fields that do (only bad fields are null), and its raw text and file go
to a quarantine table with the reason. The parse runs once: its result is written
to the shared checkpoint folder, and both tables read that copy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import free_name
from ..plans.durable import durable
from .readers import DATE_FORMAT, TIMESTAMP_FORMAT

FORMATS = ("csv", "json")


@dataclass(frozen=True)
class Parsed:
    """Records of the files, each in one or both of two tables."""

    rows: DataFrame          # all records that gave a row, with the schema's columns
    quarantine: DataFrame    # source_file, raw_record, reason, and the fields that did parse


def _required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def read_with_quarantine(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "csv",
                         keep_partial: bool = False, header: bool = True) -> Parsed:
    """Parse ``path`` (CSV or JSON lines) with ``schema``.

    ``rows`` are the well-formed records; with ``keep_partial`` also malformed ones
    of which every required (non-nullable) field was read, with null in the bad
    fields. ``quarantine`` holds every malformed record: raw text, file and reason
    (``malformed``: the text does not fit the schema; ``missing key``: it fits, but a
    required field is empty). Blank lines are no records. Column names may clash with
    those that the reader needs; they are told apart.
    """
    fmt = file_format.lower()
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported file format: {file_format}")
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    empty = spark.createDataFrame([], loose)
    raw, file, bad = (free_name(empty, n) for n in ("_raw_record", "_source_file", "_reason"))
    reader = (spark.read.schema(T.StructType([*loose.fields, T.StructField(raw, T.StringType())]))
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw)
              .option("timestampFormat", TIMESTAMP_FORMAT).option("dateFormat", DATE_FORMAT))
    found = reader.option("header", str(header).lower()).csv(path) if fmt == "csv" else reader.json(path)
    keyless = F.lit(False)
    for name in _required(schema):
        keyless = keyless | F.col(f"`{name}`").isNull()
    reason = F.when(F.col(raw).isNotNull(), "malformed").when(keyless, "missing key")
    parsed = durable(found.select("*", F.col("_metadata.file_path").alias(file), reason.alias(bad)), "parsed")
    names = [F.col(f"`{f.name}`") for f in schema.fields]
    good = F.col(bad).isNull()
    if keep_partial:
        good = good | ((F.col(bad) == "malformed") & ~keyless)
    quarantine = parsed.filter(F.col(bad).isNotNull()).select(
        F.col(file).alias("source_file"),
        F.coalesce(raw, F.to_csv(F.struct(*names)) if fmt == "csv" else F.to_json(F.struct(*names)))
        .alias("raw_record"), F.col(bad).alias("reason"), F.struct(*names).alias("fields"))
    return Parsed(parsed.filter(good).select(*names), quarantine)
