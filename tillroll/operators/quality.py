"""Data-quality checks in few passes.

* One aggregate pass gives, for every column at once: null counts, non-null
  counts, numeric-looking string counts, and mean / sample stddev of numeric
  columns (the per-column jobs of a naive checker become one wide ``agg``).
* The duplicate check groups a row fingerprint, not the rows.
* Checks that need more than one look (``read_once``) read their table once: the
  statistics are observed while its numeric columns and fingerprints are written
  to the shared checkpoint folder, and the rest is done on that narrow copy.

Results are long-form DataFrames, unpivoted with ``explode(array(struct))``
over the one-row aggregates (one row per column, bounded by the schema).
Percentages are null on an empty table, and a null percentage passes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exprs import lit_value, ratio_pct, rnd
from ..plans.durable import durable

NUMERIC_TYPES = ("int", "bigint", "float", "double")
STRING_TYPES = ("string", "varchar")


def _cols(df: DataFrame, kinds: tuple[str, ...]) -> list[str]:
    return [c for c, t in df.dtypes if t in kinds or t.startswith("varchar") and "varchar" in kinds]


def _q(c: str):
    return F.col(f"`{c}`")


def _stat_aggs(df: DataFrame) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(_q(c).isNull()).alias(f"_null_{i}"))
        aggs.append(F.count(_q(c)).alias(f"_nn_{i}"))
    for i, c in enumerate(df.columns):
        if c in _cols(df, STRING_TYPES):
            aggs.append(F.count_if(_q(c).isNotNull()
                                   & ~_q(c).rlike(rules.NUMERIC_STRING_PATTERN)).alias(f"_nonnum_{i}"))
        if c in _cols(df, NUMERIC_TYPES):
            aggs.append(F.avg(_q(c).cast("double")).alias(f"_mean_{i}"))
            aggs.append(F.stddev_samp(_q(c).cast("double")).alias(f"_sd_{i}"))
    return aggs


def column_stats(df: DataFrame) -> DataFrame:
    """One row with per-column counters (one scan for Q1, Q3, Q5 and Q4's stats)."""
    return df.agg(*_stat_aggs(df))


def _fingerprint(df: DataFrame) -> list[Column]:
    """Three 64-bit hashes of a row. Every value is hashed with whether it is null
    (the hash functions skip nulls), and -0.0 as 0.0, which grouping treats as equal."""
    parts = []
    for c, t in df.dtypes:
        col = _q(c)
        parts += [col.isNull(), F.when(col == 0, F.lit(0.0)).otherwise(col) if t in ("double", "float") else col]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_h{seed}") for seed in (1, 2, 3)]


@dataclass(frozen=True)
class Checked:
    """A table that has been read once."""

    row: dict            # the row of ``column_stats``: a few numbers per column
    stats: DataFrame     # the same as a DataFrame of literals
    copy: DataFrame      # written: numeric columns as _x_<index>, fingerprints _h1 to _h3


def read_once(df: DataFrame) -> Checked:
    """Observe the statistics of ``df`` while its numeric columns and fingerprints
    are written: what follows reads these few bytes a row, not ``df`` again."""
    numbers = _cols(df, NUMERIC_TYPES)
    seen = Observation()
    narrow = df.observe(seen, *_stat_aggs(df)).select(
        *[_q(c).cast("double").alias(f"_x_{i}") for i, c in enumerate(df.columns) if c in numbers],
        *_fingerprint(df))
    copy = durable(narrow, "quality")
    row = seen.get
    stats = df.sparkSession.range(1).select(
        *[lit_value(row[f.name]).cast(f.dataType).alias(f.name) for f in column_stats(df).schema.fields])
    return Checked(row, stats, copy)


def _unpivot(stats: DataFrame, rows: list) -> DataFrame:
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_check(df: DataFrame, dataset: str, threshold: float = rules.NULL_THRESHOLD,
               stats: DataFrame | None = None) -> DataFrame:
    """dataset, column_name, null_count, null_percentage (2 dp), passed."""
    stats = stats if stats is not None else column_stats(df)
    rows = []
    for i, c in enumerate(df.columns):
        pct = rnd(ratio_pct(F.col(f"_null_{i}"), F.col("_rows")), 2)
        rows.append(F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column_name"),
                             F.col(f"_null_{i}").alias("null_count"),
                             pct.alias("null_percentage")))
    out = _unpivot(stats, rows)
    return out.withColumn("passed", F.coalesce(
        F.col("null_percentage") <= F.lit(threshold * 100.0), F.lit(True)))


def fingerprint_groups(rows: DataFrame) -> DataFrame:
    """One aggregation buffer per fingerprint (_h1, _h2): ``n`` rows, and ``collided``:
    the rows differ in their third hash, so they are not all equal. The buffer holds
    three numbers, so copies meet in the map tasks and no row crosses the shuffle."""
    return rows.groupBy("_h1", "_h2").agg(
        F.count(F.lit(1)).alias("n"), (F.min("_h3") != F.max("_h3")).alias("collided"))


def duplicate_check(df: DataFrame, dataset: str, threshold: float = rules.DUPLICATE_THRESHOLD,
                    checked: Checked | None = None) -> DataFrame:
    """One row: total_rows, unique_rows, duplicate_count, duplicate_percentage, passed.

    One pass and one plan: fingerprints are grouped (28 bytes a row at most cross
    the shuffle) and counted. A fingerprint whose rows are not all equal counts as
    two, so the count is exact unless two different rows agree in 192 bits, or three
    in 128."""
    groups = fingerprint_groups(df.select(*_fingerprint(df)) if checked is None else checked.copy)
    t = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("collided"), 2).otherwise(1)), F.lit(0)).cast("long").alias("unique_rows"))
    t = t.withColumn("duplicate_count", F.col("total_rows") - F.col("unique_rows"))
    t = t.withColumn("duplicate_percentage",
                     rnd(ratio_pct(F.col("duplicate_count"), F.col("total_rows")), 2))
    return t.select(F.lit(dataset).alias("dataset"), "*").withColumn(
        "passed", F.coalesce(F.col("duplicate_percentage") <= F.lit(threshold * 100.0),
                             F.lit(True)))


def numeric_string_check(df: DataFrame, dataset: str, stats: DataFrame | None = None) -> DataFrame:
    """Per string column: non_null_count, non_numeric_count, looks_numeric
    (non-null values exist and all look like unsigned numbers), passed."""
    stats = stats if stats is not None else column_stats(df)
    strings = _cols(df, STRING_TYPES)
    rows = []
    for i, c in enumerate(df.columns):
        if c in strings:
            rows.append(F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column_name"),
                                 F.col(f"_nn_{i}").alias("non_null_count"),
                                 F.col(f"_nonnum_{i}").alias("non_numeric_count")))
    if not rows:
        return _empty(df, "dataset string, column_name string, non_null_count bigint, "
                          "non_numeric_count bigint, looks_numeric boolean, passed boolean")
    out = _unpivot(stats, rows)
    looks = (F.col("non_null_count") > 0) & (F.col("non_numeric_count") == 0)
    return out.withColumn("looks_numeric", looks).withColumn("passed", ~looks)


def outlier_check(df: DataFrame, dataset: str, sigma: float = rules.OUTLIER_SIGMA,
                  checked: Checked | None = None) -> DataFrame:
    """Per numeric column with a positive stddev: mean, stddev, bounds
    mean -/+ sigma*stddev (2 dp), outlier_count, outlier_percentage of
    non-null values (2 dp). Outliers are reported, never failed.

    ``df`` is read once (``read_once``); the numeric copy is counted against the
    bounds of its one stats row, which are literals."""
    nums = [(i, c) for i, c in enumerate(df.columns) if c in _cols(df, NUMERIC_TYPES)]
    schema = ("dataset string, column_name string, mean double, stddev double, "
              "lower_bound double, upper_bound double, outlier_count bigint, "
              "outlier_percentage double, passed boolean")
    if not nums:
        return _empty(df, schema)
    checked = checked or read_once(df)
    # The observed row (a few numbers per column): its bounds are literals.
    row = checked.row
    b = {}
    for i, _ in nums:
        mean, sd = row[f"_mean_{i}"], row[f"_sd_{i}"]
        known = mean is not None and sd is not None
        b[i] = [lit_value(v).cast("double") for v in (
            mean, sd, mean - sigma * sd if known else None, mean + sigma * sd if known else None)]
    counted = checked.copy.agg(*[
        F.count_if((F.col(f"_x_{i}") < b[i][2]) | (F.col(f"_x_{i}") > b[i][3])).alias(f"_out_{i}")
        for i, _ in nums])
    rows = [F.struct(
        F.lit(dataset).alias("dataset"), F.lit(c).alias("column_name"),
        b[i][0].alias("mean"), b[i][1].alias("stddev"),
        rnd(b[i][2], 2).alias("lower_bound"), rnd(b[i][3], 2).alias("upper_bound"),
        F.col(f"_out_{i}").alias("outlier_count"),
        rnd(ratio_pct(F.col(f"_out_{i}"), lit_value(row[f"_nn_{i}"]).cast("long")), 2)
        .alias("outlier_percentage"))
        for i, c in nums]
    out = _unpivot(counted, rows).filter(F.col("stddev").isNotNull() & (F.col("stddev") > 0))
    return out.withColumn("passed", F.lit(True))


def integrity_check(df: DataFrame, dataset: str, stats: DataFrame | None = None) -> DataFrame:
    """Null customer_id on a table that has transaction_id and customer_id:
    one row (dataset, null_customer_ids, passed); no row for other tables.
    With ``stats`` (from ``column_stats``) it reuses that pass's null count."""
    if "customer_id" not in df.columns or "transaction_id" not in df.columns:
        return _empty(df, "dataset string, null_customer_ids bigint, passed boolean")
    if stats is not None:
        i = df.columns.index("customer_id")
        counted = stats.select(F.col(f"_null_{i}").alias("null_customer_ids"))
    else:
        counted = df.agg(F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"))
    return counted.select(
        F.lit(dataset).alias("dataset"), "null_customer_ids",
        (F.col("null_customer_ids") == 0).alias("passed"))


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, relation: str) -> DataFrame:
    """Referential integrity as EXCEPT DISTINCT semantics (a null key is an
    orphan unless the parent has a null key): one row with distinct child keys
    and orphan keys."""
    ck = child.select(key).distinct()
    pk = parent.select(F.col(key).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
    j = ck.join(pk, ck[key].eqNullSafe(pk["_pk"]), "left")
    return j.agg(F.count("*").alias("distinct_keys"),
                 F.count_if(F.col("_hit").isNull()).alias("orphan_keys")).select(
        F.lit(relation).alias("relation"), F.lit(key).alias("key"), "distinct_keys",
        "orphan_keys", (F.col("orphan_keys") == 0).alias("passed"))


def cleanse(df: DataFrame) -> DataFrame:
    """Fill missing customer_segment / country and drop exact duplicate rows, in
    one plan that reads its input once."""
    fills = {k: v for k, v in (("customer_segment", "Unknown"), ("country", "Not Specified"))
             if k in df.columns}
    out = df.fillna(fills) if fills else df
    return out.dropDuplicates()


def quality_report(df: DataFrame, dataset: str, null_threshold: float = rules.NULL_THRESHOLD,
                   duplicate_threshold: float = rules.DUPLICATE_THRESHOLD,
                   sigma: float = rules.OUTLIER_SIGMA) -> DataFrame:
    """All checks for one table in long form:
    dataset, check_name, column_name, metric, value (double), passed.

    ``df`` is read once (``read_once``): nulls, types and integrity come from its
    stats row, duplicates and outliers from the narrow copy."""
    checked = read_once(df)
    stats = checked.stats

    def longf(frame, check, col_expr, metrics):
        return frame.select(F.explode(F.array(*[
            F.struct(F.col("dataset"), F.lit(check).alias("check_name"),
                     col_expr.alias("column_name"), F.lit(m).alias("metric"),
                     F.col(m).cast("double").alias("value"), F.col("passed"))
            for m in metrics])).alias("r")).select("r.*")

    parts = [
        longf(null_check(df, dataset, null_threshold, stats), "null_values",
              F.col("column_name"), ["null_count", "null_percentage"]),
        longf(duplicate_check(df, dataset, duplicate_threshold, checked), "duplicates",
              F.lit(None).cast("string"),
              ["total_rows", "unique_rows", "duplicate_count", "duplicate_percentage"]),
        longf(numeric_string_check(df, dataset, stats), "data_types",
              F.col("column_name"), ["non_null_count", "non_numeric_count"]),
        longf(outlier_check(df, dataset, sigma, checked), "outliers", F.col("column_name"),
              ["outlier_count", "outlier_percentage", "lower_bound", "upper_bound"]),
        longf(integrity_check(df, dataset, stats), "referential_integrity",
              F.lit("customer_id"), ["null_customer_ids"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quality_verdict(report: DataFrame) -> DataFrame:
    """dataset -> passed (every check row passed)."""
    return report.groupBy("dataset").agg(F.bool_and("passed").alias("passed"))


def freshness(df: DataFrame, dataset: str, date_column: str, as_of,
              max_age_hours: float = 24.0) -> DataFrame:
    """One row: latest value, hours_old against ``as_of``, is_fresh
    (a table with no values is not fresh)."""
    # Wall-clock arithmetic on TIMESTAMP_NTZ: the result does not depend on the
    # session time zone or on daylight-saving offsets between the two instants.
    latest = df.agg(F.max(date_column).cast("timestamp_ntz").alias("latest"))
    asof = F.lit(as_of).cast("timestamp_ntz")
    hours = F.timestamp_diff("MICROSECOND", F.col("latest"), asof) / F.lit(3.6e9)
    return latest.select(
        F.lit(dataset).alias("dataset"), F.lit(date_column).alias("column_name"),
        F.col("latest"),
        hours.alias("hours_old"),
        F.coalesce(hours <= F.lit(float(max_age_hours)), F.lit(False)).alias("is_fresh"))


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def save_quality_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the long-form quality report as JSON lines (one file per task)."""
    report.write.mode(mode).json(path)
