"""Mixing sources to target weights as a time-varying curriculum.

1. Each source's size is the word count of its documents. Targets share
   ``share`` of all words by weight; a target stops at ``most`` times its
   source's size and the excess is reshared by weight until none is above. That
   water level has a closed form over the sources ordered by cap / weight, so
   no loop runs.
2. Documents of a source lie end to end in a hashed order; ``offset`` is the
   number of the source's words before a document. Its e-th epoch demands words
   offset + e * source size. Words beyond the target are not taken, so a source
   takes its target exactly; the document at that border is taken in part.
3. Each source has a weight schedule over training time 0..1 (piecewise linear).
   Its integral is the cumulative demand; inverting it at the offset / target
   gives the time at which the copy is read. Sorting by that time gives the mix.

Offsets come from bucketed prefix sums (``numbering``), so a source that holds
a third of all rows is spread over as many tasks as any other rows. Only
DataFrame functions run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable
from .numbering import bucket_offsets
from .ordering import numbered
from .sized import broadcast_if_small, free_name

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 8192
COPIES_PER_RUN = 4096
WEIGHTS = (5, 2, 1)
#: Knots (time, weight) by rank of the source, repeating: early, even, late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def order_key(doc_id: Column, text: Column) -> Column:
    """Where a document stands in its source: an md5 of its id and text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.lit(":"),
                          F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def inverse_demand(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the integral of a piecewise-linear weight, scaled to 1 at
    the end, reaches ``share`` (0..1). Weights must not be negative, and their
    integral not 0."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total, done, branches = sum(areas), 0.0, []
    if total <= 0:
        raise ValueError("a schedule needs some weight")
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas):
        rest = share * F.lit(total) - F.lit(done)
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + rest * F.lit(2 * slope)))
        step = F.lit(t0) + F.coalesce(F.try_divide(rest * 2, root + F.lit(w0)), F.lit(0.0))
        branches.append((done + area, step))
        done += area
    out = branches[-1][1]
    for end, step in reversed(branches[:-1]):
        out = F.when(share * F.lit(total) < F.lit(end), step).otherwise(out)
    return out


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """source, source_size, source_rank, target. One row per source (null is
    one), so its windows hold one row per source. Weights repeat over the
    sources in code-point order, null last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                        (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = (per.select("*", (F.row_number().over(by_name) - 1).alias("source_rank"))
              .select("*", pick.alias("weight"), (F.col("source_size") * most).alias("cap")))
    by_level = W.orderBy((F.col("cap") / F.col("weight")).asc(), "source_rank")
    levels = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("_capped"),
        F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing)).alias("_open"),
        F.sum("source_size").over(W.partitionBy()).alias("_all"))
    level = (F.col("_all") * F.lit(share) - F.col("_capped")) / F.col("_open")
    # The level of the first source whose cap lies above it; none if all are full.
    leveled = levels.select("*", F.min(F.when(level < F.col("cap") / F.col("weight"),
                                              F.struct(F.col("cap") / F.col("weight"),
                                                       "source_rank", level.alias("level"))))
                            .over(W.partitionBy()).alias("_at"))
    target = F.least(F.coalesce(F.col("_at.level") * F.col("weight"), F.col("cap").cast("double")),
                     F.col("cap").cast("double"))
    return leveled.select("source", "source_size", "source_rank", target.alias("target"))


def each_copy(groups: DataFrame) -> DataFrame:
    """A row (``copy`` from 0) for each of a group's ``copies``. Large groups are first
    dealt out as runs of ``COPIES_PER_RUN``, so one task never makes all copies."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    run = F.explode(F.sequence(zero, F.expr(f"(copies - 1) div {COPIES_PER_RUN}"))).alias("run")
    runs = groups.select("*", run).repartition("order_key", "run")
    first = F.col("run") * COPIES_PER_RUN
    last = F.least(F.col("copies"), first + COPIES_PER_RUN) - one
    return runs.select("*", F.explode(F.sequence(first, last)).alias("copy")).drop("run", "copies")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2,
        schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """Words taken from every document and the times at which they are read.

    Returns one row per row of ``docs`` (``doc_id``, ``text``, ``source``):
    doc_id, source, order_key, size, source_size, target, taken, first_words and
    second_words (by epoch), first_at and second_at (times of the epochs' copies,
    null where none is taken), and read_key (what ``training_order`` sorts by).
    ``most`` may be 1 or 2.

    A null text has size 0, like an empty one: nothing is taken from it. Null
    sources are one source, last in order. Null ids are ordinary values.
    Repeated rows each count. An empty table gives an empty result. Other
    columns are not looked at.
    """
    if most not in (1, 2):
        raise ValueError("a mix reads a document once or twice at most")
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = durable(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        order_key(F.col("doc_id"), text).alias("order_key")), "mix-sizes")
    # Rows that repeat id and text lie side by side: they are one row here, so a text
    # that a third of the rows repeat does not meet in one window.
    groups = durable(sizes.groupBy("source", "order_key", "size").agg(
        F.count(F.lit(1)).alias("copies"), F.first("doc_id").alias("doc_id"))
        .withColumn("words", F.col("size") * F.col("copies")), "mix-groups")
    n = groups.count()
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    # Buckets follow the order key, so bucket order and key order agree.
    place = F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long")
    rows = groups.select("*", F.floor(place * buckets / F.lit(2 ** 32)).cast("long").alias("_bucket"))
    before = bucket_offsets(rows, ["source"], "_bucket", "words")
    inside = (W.partitionBy("source", "_bucket").orderBy("order_key", "size")
              .rowsBetween(W.unboundedPreceding, -1))
    summed = rows.select("*", F.coalesce(F.sum("words").over(inside), F.lit(0)).alias("_in"))
    targets = source_targets(sizes, weights, share, most)
    a, b, t = summed.alias("a"), before.alias("b"), targets.alias("t")
    placed = (a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))
                     & (F.col("a._bucket") == F.col("b._bucket")))
              .select("a.doc_id", "a.source", "a.size", "a.order_key", "a.copies",
                      (F.col("b.before") + F.col("a._in")).alias("start")))
    p = each_copy(placed).alias("p")
    offset = (F.col("p.start") + F.col("p.copy") * F.col("p.size")).alias("offset")
    joined = (p.join(t, F.col("p.source").eqNullSafe(F.col("t.source")))
              .select("p.doc_id", "p.source", "p.size", "p.order_key", "t.source_size",
                      "t.source_rank", "t.target", offset))
    words = F.floor(F.col("target") + F.lit(0.5)).cast("long")

    def part(epoch: int) -> Column:
        return F.greatest(F.lit(0).cast("long"),
                          F.least(F.col("size"), words - F.col("offset")
                                  - F.lit(epoch) * F.col("source_size")))

    def at(epoch: int) -> Column:
        demanded = F.try_divide(F.col("offset") + F.lit(epoch) * F.col("source_size"), F.col("target"))
        out = None
        for i, knots in enumerate(schedules):
            this = inverse_demand(demanded, knots)
            out = (F.when(F.col("source_rank") % len(schedules) == i, this) if out is None
                   else out.when(F.col("source_rank") % len(schedules) == i, this))
        return F.when(part(epoch) > 0, out)

    taken = joined.select("*", (part(0) + part(1)).alias("taken"), part(0).alias("first_words"),
                          part(1).alias("second_words"),
                          at(0).alias("first_at"), at(1).alias("second_at"))
    unread = F.lit(1.0) + F.conv(F.substring("order_key", 1, 8), 16, 10).cast("double") / 2 ** 32
    return taken.select("doc_id", "source", "order_key", "size", "source_size", "target", "taken",
                        "first_words", "second_words", "first_at", "second_at",
                        F.coalesce(F.col("first_at"), unread).alias("read_key"))


def training_order(rows: DataFrame, at: str = "read_key") -> DataFrame:
    """``rows`` range-sorted by time. Documents the mix leaves out hold keys
    above 1 (spread, so that they fill no single range) and come last."""
    return rows.repartitionByRange(F.col(at), F.col("doc_id")).sortWithinPartitions(at, "doc_id")


def _numbered(rows: DataFrame, repeated: DataFrame, key: str, name: str, order: Sequence[Column]) -> DataFrame:
    """``rows`` with a number from 1 among the rows of the same ``key``. Only rows of
    ``repeated`` keys are ordered, by a range sort that spreads a key's rows."""
    again = broadcast_if_small(repeated.withColumnRenamed("order_key", key))
    keys = [free_name(rows.columns, f"_order{i}") for i in range(len(order) + 1)]
    tagged = durable(rows.join(again, key, "left_semi").withColumns(
        dict(zip(keys, [*order, F.monotonically_increasing_id()]))), "mix-repeated-rows")
    told = numbered(tagged, [key], keys, "mix-repeated-rows")
    return rows.join(again, key, "left_anti").withColumn(name, F.lit(1).cast("long")).unionByName(
        told.withColumn(name, F.col("pos") + 1).select(*rows.columns, name))


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The documents of a mix in training order, all columns as they are, a row
    for each time a document is read. Documents stay whole: one that a target
    cuts is read if at least half of its words are taken. Rows that repeat both
    id and text each take part: they are numbered by source, then by their other
    columns as JSON, and meet the mix's rows of that source in order.
    """
    key, at = free_name(docs.columns, "_mix_key"), free_name(docs.columns, "_mix_at")
    number = free_name(docs.columns, "_mix_number")
    keyed = docs.withColumn(key, order_key(F.col("doc_id"), F.col("text")))
    mixed = durable(mix(docs, **parameters), "mixed").withColumnRenamed("order_key", key)
    on = [key]
    repeated = durable(mixed.groupBy(key).count().filter("count > 1").select(
        F.col(key).alias("order_key")), "mix-repeated")
    if repeated.count():
        on = [key, number]
        others = [F.col(c) for c in docs.columns if c.lower() != "text"]
        keyed = _numbered(keyed, repeated, key, number, [
            F.col("source").cast("string"), F.to_json(F.struct(*others))])
        mixed = _numbered(mixed, repeated, key, number, [
            F.col("source"), F.coalesce("first_at", F.lit(2.0)), -F.col("first_words"),
            F.coalesce("second_at", F.lit(2.0)), -F.col("second_words")])

    def whole(epoch: str) -> Column:
        words = F.col(f"{epoch}_words")
        return F.when((words > 0) & (words * 2 >= F.col("size")), F.col(f"{epoch}_at"))

    reads = broadcast_if_small(durable(mixed.select(*on, F.explode(
        F.array_compact(F.array(whole("first"), whole("second")))).alias(at)), "mix-reads"))
    read = keyed.join(reads, on)
    return read.repartitionByRange(at, key).sortWithinPartitions(at, key).select(*docs.columns)
