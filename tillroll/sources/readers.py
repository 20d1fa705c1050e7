"""Readers: registered-schema CSV, and format dispatch over Parquet/CSV/JSON.

Failures raise; callers decide. Nothing here counts rows: use
``pyspark.sql.Observation`` on the consuming action when a count is wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import schema_for

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def with_ingestion_metadata(df: DataFrame) -> DataFrame:
    """Add ``ingestion_timestamp`` and the per-row ``source_file``."""
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_file": F.col("_metadata.file_path"),
    })


def read_csv_with_schema(spark: SparkSession, path: str, schema_name: str,
                         add_metadata: bool = True) -> DataFrame:
    """CSV with header and a registered schema; malformed fields become null."""
    df = (spark.read.schema(schema_for(schema_name))
          .option("header", "true")
          .option("timestampFormat", TIMESTAMP_FORMAT)
          .option("dateFormat", DATE_FORMAT)
          .option("mode", "PERMISSIVE")
          .csv(path))
    return with_ingestion_metadata(df) if add_metadata else df


_READERS = {
    "parquet": lambda r, p: r.parquet(p),
    "csv": lambda r, p: r.option("header", "true").csv(p),
    "json": lambda r, p: r.json(p),
}


def read_table(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Read Parquet, header-only CSV (all strings) or JSON lines by format name."""
    fmt = file_format.lower()
    if fmt not in _READERS:
        raise ValueError(f"Unsupported file format: {file_format}")
    return _READERS[fmt](spark.read, path)
