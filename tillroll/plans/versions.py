"""Versioned tables: write aside, verify, then switch all tables at once.

Layout under a root folder:

    <zone>/<table>/version=<v>/[partition folders]   data, never changed once written
    _manifests/<v>/                                  one row per table and partition
    _current/<v>                                     an empty file: version <v> is complete

A run writes its data beside the old, reads it back, writes a manifest of everything
that readers should see, and creates the marker last. Creating one empty file is
atomic on HDFS and on object stores, so readers see all tables of a run or none: a
run that dies midway leaves the old version current. A manifest names, for every
partition, the version that holds it, so a rerun of some partitions writes those
only and keeps the others where they are.

Every partition has a digest that does not depend on order: the sum of its rows' hashes.
The sum over all rows is observed while the data is written and compared with what the
files give back; the digests per partition stay in the manifest for later checks.

What passes the driver: one manifest row per partition, and one number per table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import free_name

DIGEST = "decimal(38,0)"
DIGEST_BITS = 22
MANIFEST = ("table string, zone string, data_version string, part string, rows long, digest decimal(38,0), "
            "partition_columns array<string>, schema_json string")
VERSION = "version"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def current_version(spark: SparkSession, root: str) -> str | None:
    """The newest complete version; None before the first."""
    names = _names(spark, f"{root.rstrip('/')}/_current")
    return names[-1] if names else None


def new_version(spark: SparkSession, root: str) -> str:
    """A name that sorts behind all versions so far, complete or not."""
    root = root.rstrip("/")
    names = _names(spark, f"{root}/_current") + _names(spark, f"{root}/_manifests")
    last = max((int(n.split("-")[0]) for n in names), default=0)
    return f"{last + 1:08d}-{uuid.uuid4().hex[:8]}"


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of the named columns; each is hashed with whether it is null."""
    parts = [p for c in columns for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*parts)


def digest(columns: Sequence[str]) -> Column:
    """The sum of the rows' hashes: any order and any split of the rows gives the
    same, and a repeated row counts twice. Summed as three longs of 22 bits a row
    (the highest is signed), which is exact for up to 2^41 rows."""
    h, low = row_hash(columns), F.lit((1 << DIGEST_BITS) - 1)
    parts = [h.bitwiseAND(low), F.shiftright(h, DIGEST_BITS).bitwiseAND(low), F.shiftright(h, 2 * DIGEST_BITS)]
    whole = F.lit(0).cast(DIGEST)
    for i, part in enumerate(parts):
        weight = F.lit(Decimal(1 << (i * DIGEST_BITS))).cast("decimal(18,0)")
        whole = whole + F.coalesce(F.sum(part), F.lit(0)).cast("decimal(19,0)") * weight
    return whole.cast(DIGEST)


def part_name(partition_columns: Sequence[str]) -> Column:
    """A partition as JSON of its columns; ``{}`` for a table without partitions."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in partition_columns])) if partition_columns else F.lit("{}")


@dataclass(frozen=True)
class Staged:
    """A table that has been written and read back, but is not current yet."""

    table: str
    rows: int
    entries: DataFrame      # manifest rows
    path: str


class VerificationError(RuntimeError):
    """The files do not give back what was written."""


def partition_digests(df: DataFrame, columns: Sequence[str], partition_columns: Sequence[str]) -> DataFrame:
    """(part, rows, digest) of every partition. Rows are grouped by the columns; their
    JSON is made once per group (two groups may have the same)."""
    n, d = free_name(df, "_rows"), free_name(df, "_digest")
    by_value = df.groupBy(*[F.col(f"`{c}`") for c in partition_columns]).agg(
        F.count(F.lit(1)).alias(n), digest(columns).alias(d)).filter(F.col(n) > 0)
    return by_value.groupBy(part_name(partition_columns).alias("part")).agg(
        F.sum(n).alias("rows"), F.sum(d).cast(DIGEST).alias("digest"))


def stage(df: DataFrame, root: str, zone: str, table: str, version: str,
          partition_columns: Sequence[str] = (), before_verify=None) -> Staged:
    """Write ``df`` aside as ``version`` of the table, and verify what the files
    hold. Raises ``VerificationError`` if it differs. Rows are rebalanced by the
    partition columns, so a partition is written by one task, or by a few where it
    is large. An empty string in a partition column becomes null, as in any
    partitioned folder, so it is written as null."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{zone}/{table}/{VERSION}={version}"
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    out = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in partition_columns if c in strings})
    seen = Observation()
    rows = out.hint("rebalance", *partition_columns) if partition_columns else out
    writer = rows.observe(seen, F.count(F.lit(1)).alias("rows"), digest(out.columns).alias("digest")).write
    writer = writer.mode("error").option("compression", "snappy")
    (writer.partitionBy(*partition_columns) if partition_columns else writer).parquet(path)
    if before_verify is not None:
        before_verify(path)
    back = spark.read.schema(_nullable(out.schema)).parquet(path)
    entries = partition_digests(back, out.columns, partition_columns).select(
        F.lit(table).alias("table"), F.lit(zone).alias("zone"), F.lit(version).alias("data_version"), "part",
        "rows", "digest", F.array(*[F.lit(c) for c in partition_columns]).cast("array<string>")
        .alias("partition_columns"), F.lit(_nullable(out.schema).json()).alias("schema_json"))
    entries = spark.createDataFrame(entries.collect(), MANIFEST)      # one row per partition
    found = entries.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("digest"), F.lit(0))).first()
    wrote = seen.get
    if (found[0], int(found[1])) != (wrote["rows"], int(wrote["digest"])):
        raise VerificationError(f"{path}: wrote {wrote['rows']} rows, digest {wrote['digest']}; "
                                f"read {found[0]} rows, digest {found[1]}")
    if not wrote["rows"]:       # keeps the schema of an empty table
        entries = spark.createDataFrame([(table, zone, version, "{}", 0, Decimal(0), list(partition_columns),
                                          _nullable(out.schema).json())], MANIFEST)
    return Staged(table, wrote["rows"], entries, path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def manifest(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The manifest of a version (the current one by default)."""
    version = version or current_version(spark, root)
    if version is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/_manifests/{version}")


def switch(spark: SparkSession, root: str, version: str, staged: Sequence[Staged],
           replace: str = "tables") -> None:
    """Make ``version`` current: the staged tables, and all else as it was.

    ``replace="tables"``: a staged table replaces the old one as a whole.
    ``replace="partitions"``: only the partitions that were staged are replaced."""
    root = root.rstrip("/")
    new = reduce(DataFrame.unionByName, [s.entries for s in staged])
    keys = {"tables": ["table"], "partitions": ["table", "part"]}[replace]
    kept = manifest(spark, root).join(new.select(*keys).distinct(), keys, "left_anti").select(*new.columns)
    kept.unionByName(new).coalesce(1).write.mode("error").parquet(f"{root}/_manifests/{version}")
    fs, marker = _path(spark, f"{root}/_current/{version}")
    fs.create(marker, False).close()


def read_current(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    """A table as the manifest of ``version`` (the current one by default) lists it.
    Only folders of the versions it names are listed, and only its partitions read."""
    root = root.rstrip("/")
    rows = manifest(spark, root, version).filter(F.col("table") == table).collect()
    if not rows:
        raise KeyError(f"No table '{table}' in {root}")
    by_version: dict[str, list[str]] = {}
    for r in rows:
        by_version.setdefault(r.data_version, []).append(r.part)
    base = f"{root}/{rows[0].zone}/{table}"
    schema = T.StructType.fromJson(json.loads(rows[0].schema_json))
    whole = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
    df = (spark.read.schema(whole).option("basePath", base)
          .parquet(*[f"{base}/{VERSION}={v}" for v in by_version]))
    if len(by_version) > 1:
        part = part_name(rows[0].partition_columns)
        df = df.filter(reduce(Column.__or__, [
            (F.col(VERSION) == v) & part.isin(parts) for v, parts in by_version.items()]))
    return df.select(*schema.names)


def verify_current(spark: SparkSession, root: str) -> DataFrame:
    """Every partition of the current version recounted from its files: table, part,
    rows, rows_found, digest, digest_found, passed."""
    listed = manifest(spark, root)
    found = None
    for r in listed.select("table", "partition_columns").distinct().collect():
        df = read_current(spark, root, r.table)
        part = partition_digests(df, df.columns, r.partition_columns).withColumn("table", F.lit(r.table))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "table string, part string, rows long, rows_found long, "
                                         "digest decimal(38,0), digest_found decimal(38,0), passed boolean")
    f = found.withColumnsRenamed({"rows": "rows_found", "digest": "digest_found"})
    zero = F.lit(0)
    return (listed.filter("rows > 0").join(f, ["table", "part"], "full").select(
        "table", "part", F.coalesce("rows", zero).alias("rows"), F.coalesce("rows_found", zero).alias("rows_found"),
        "digest", "digest_found")
        .withColumn("passed", F.col("digest").eqNullSafe(F.col("digest_found")) & (
            F.col("rows") == F.col("rows_found"))))


def footprint(spark: SparkSession, root: str) -> DataFrame:
    """Per current table: files that hold rows, their bytes and rows as the files' own
    footers give them (no column is read), and how many data versions it is made of."""
    listed = manifest(spark, root)
    out = None
    for r in listed.groupBy("table").agg(F.count_distinct("data_version").alias("n")).collect():
        df = read_current(spark, root, r.table)
        files = df.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
        row = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(
            F.lit(r.table).alias("table"), "files", "bytes", "rows", F.lit(r.n).cast("long").alias("data_versions"))
        out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame(
        [], "table string, files long, bytes long, rows long, data_versions long")


def drop_old_versions(spark: SparkSession, root: str) -> list[str]:
    """Delete data folders that the current manifest does not name, and manifests and
    markers of other versions. Readers of an old version fail afterwards."""
    root = root.rstrip("/")
    now = current_version(spark, root)
    listed = manifest(spark, root).select("zone", "table", "data_version").distinct().collect()
    keep = {(r.zone, r.table, f"{VERSION}={r.data_version}") for r in listed}
    gone = [f"{root}/{zone}/{table}/{name}" for zone, table in {(r.zone, r.table) for r in listed}
            for name in _names(spark, f"{root}/{zone}/{table}") if (zone, table, name) not in keep]
    gone += [f"{root}/{d}/{n}" for d in ("_current", "_manifests") for n in _names(spark, f"{root}/{d}") if n != now]
    for path in gone:
        fs, p = _path(spark, path)
        fs.delete(p, True)
    return gone
