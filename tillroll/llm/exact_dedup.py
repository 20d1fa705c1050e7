"""Exact deduplication against an immutable snapshot with binary fuse filters.

A snapshot is built once: the digests of its texts, one group per digest, and a
static binary fuse filter for every hash bucket of its digests. An incoming
batch is first grouped by digest (its own duplicates never touch the snapshot).
Each distinct digest is screened by its bucket's filter. A negative is new for
certain. A positive joins the snapshot's exact bucket by key and digest, and
the texts of the two representatives are compared byte by byte.

What moves: digests (about 60 bytes a row), and texts of one representative per
matched digest only (found by a broadcast of their ids while those are few, by
a shuffle join beyond). No bucket, filter or group grows with the number of copies
of a text: groups are pre-aggregated by digest before anything is bucketed.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from . import fuse_filter
from .sized import broadcast_if_small, free_name

KEYS_PER_BUCKET = 4096


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _groups(digests: DataFrame) -> DataFrame:
    """One row per digest: rows, and the row that stays (largest doc_id; of
    rows that repeat it, the one read last)."""
    return digests.groupBy("text_sha256", "key").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "row_tag")).alias("top"))


def _bucket(buckets: int) -> Column:
    return F.pmod("key", F.lit(buckets)).alias("bucket")


@dataclass(frozen=True)
class Snapshot:
    """Written tables of one immutable snapshot."""

    docs: DataFrame        # doc_id, text as given
    digests: DataFrame     # doc_id, row_tag, text_sha256, key
    groups: DataFrame      # text_sha256, key, n, top
    filters: DataFrame     # bucket, filter
    buckets: int


def digest_table(docs: DataFrame, name: str) -> DataFrame:
    """doc_id, row_tag, text_sha256 and a 64-bit key of every row. The tag
    tells rows apart that repeat a doc_id; the table is written, so it stays."""
    sha = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      text_digest(F.col("text")).alias("text_sha256"),
                      F.monotonically_increasing_id().alias("row_tag"))
    return durable(sha.select("*", F.xxhash64("text_sha256").alias("key")), name)


def build_snapshot(docs: DataFrame, digests: DataFrame | None = None) -> Snapshot:
    digests = digest_table(docs, "snapshot-digests") if digests is None else digests
    groups = durable(_groups(digests), "snapshot-groups")
    buckets = max(1, -(-groups.count() // KEYS_PER_BUCKET))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": frame["bucket"].iloc[:1],
                             "filter": [fuse_filter.build(frame["key"].to_numpy().view(np.uint64))]})

    filters = durable(groups.select("key", _bucket(buckets)).groupBy("bucket")
                      .applyInPandas(build, "bucket long, filter binary"), "snapshot-filters")
    return Snapshot(docs.select("doc_id", "text"), digests, groups, filters, buckets)


def screen(snapshot: Snapshot, groups: DataFrame) -> DataFrame:
    """Batch groups (a written table: text_sha256, key, n, top) that the
    snapshot's filters do not rule out. The batch's share of a bucket is dealt
    into slices of about ``KEYS_PER_BUCKET`` keys, whatever the snapshot's size,
    and each slice meets a copy of the bucket's filter."""
    def probe(batch: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        keep = fuse_filter.contains(own["filter"].iloc[0] if len(own) else None,
                                    batch["key"].to_numpy(np.int64).view(np.uint64))
        return batch.loc[keep, ["text_sha256", "key"]]

    slices = max(1, -(-groups.count() // (KEYS_PER_BUCKET * snapshot.buckets)))
    own = F.pmod(F.xxhash64("key"), F.lit(slices)).alias("slice")
    keys = groups.select("text_sha256", "key", _bucket(snapshot.buckets), own)
    filters = snapshot.filters.select("*", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"))
    return (keys.groupBy("bucket", "slice").cogroup(filters.groupBy("bucket", "slice"))
            .applyInPandas(probe, "text_sha256 string, key long"))


def _same_bytes(snapshot: Snapshot, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (text_sha256, s_id, b_id) whose two texts are equal byte for byte.
    A doc_id may repeat with other texts, so the digest has to fit too."""
    ids = broadcast_if_small(durable(pairs, "dedup-positives"))

    def texts(source: DataFrame, column: str, name: str) -> DataFrame:
        d, p = source.alias("d"), ids.alias("p")
        found = d.join(p, F.col("d.doc_id").eqNullSafe(F.col(f"p.{column}")))
        return (found.select(F.col("p.text_sha256").alias("text_sha256"),
                             normalised(F.col("d.text")).alias(name))
                .filter(F.sha2(F.col(name).cast("binary"), 256) == F.col("text_sha256"))
                .dropDuplicates(["text_sha256"]))

    left = texts(snapshot.docs, "s_id", "s_text")
    right = texts(docs, "b_id", "b_text")
    return (left.join(right, "text_sha256").filter(F.col("s_text") == F.col("b_text"))
            .select("text_sha256"))


def dedup(snapshot: Snapshot, docs: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Group every row of the snapshot and of the incoming ``docs``.

    Returns one row per row of both: doc_id, keep_id (doc_id of the row that
    stays: the largest of the group), group_size, kept, text_sha256, via
    (``snapshot``: a snapshot row, ``match``: incoming, its text is in the
    snapshot, ``batch``: incoming, new to the snapshot).

    A null text is an empty one. Null doc_ids sort below all others; a group
    without any id has a null keep_id. Exactly one row of a group is kept, also
    where a row is repeated with the same doc_id. Empty inputs give empty
    results. Other columns are not looked at.
    """
    digests = digest_table(docs, "batch-digests") if digests is None else digests
    batch = durable(_groups(digests), "batch-groups")
    positive = screen(snapshot, batch)
    s, b = snapshot.groups.alias("s"), batch.alias("b")
    exact = (positive.alias("p").join(b, "text_sha256")
             .join(s, (F.col("s.text_sha256") == F.col("b.text_sha256"))
                   & (F.col("s.key") == F.col("b.key")))
             .select(F.col("b.text_sha256").alias("text_sha256"),
                     F.col("s.top.doc_id").alias("s_id"), F.col("b.top.doc_id").alias("b_id")))
    same = _same_bytes(snapshot, docs, exact)
    both = (same.join(s, "text_sha256").join(b, "text_sha256")
            .select("text_sha256", (F.col("s.n") + F.col("b.n")).alias("both_n"),
                    F.greatest(F.struct(F.col("s.top.doc_id").alias("doc_id"), F.lit(0).alias("side"),
                                        F.col("s.top.row_tag").alias("row_tag")),
                               F.struct(F.col("b.top.doc_id").alias("doc_id"), F.lit(1).alias("side"),
                                        F.col("b.top.row_tag").alias("row_tag"))).alias("both_top")))
    both = durable(both, "dedup-matches")

    def verdicts(groups: DataFrame, rows: DataFrame, side: int, alone: str, matched: str) -> DataFrame:
        own = F.struct(F.col("top.doc_id").alias("doc_id"), F.lit(side).alias("side"),
                       F.col("top.row_tag").alias("row_tag"))
        final = (groups.join(both, "text_sha256", "left")
                 .select("text_sha256", F.coalesce("both_n", "n").alias("group_size"),
                         F.coalesce("both_top", own).alias("stays"),
                         F.when(F.col("both_n").isNull(), alone).otherwise(matched).alias("via")))
        return rows.join(final, "text_sha256").select(
            "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
            ((F.col("stays.side") == side) & (F.col("stays.row_tag") == F.col("row_tag"))).alias("kept"),
            "text_sha256", "via")

    return verdicts(snapshot.groups, snapshot.digests, 0, "snapshot", "snapshot").unionByName(
        verdicts(batch, digests, 1, "batch", "match"))


def dedup_corpus(docs: DataFrame) -> DataFrame:
    """``dedup`` of one table: the older half by doc_id (null ids are new) is
    the snapshot, the newer half the incoming batch. Digests are made in one
    pass over the texts."""
    digests = digest_table(docs, "corpus-digests")
    ends = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    cut = 0 if ends[0] is None else (ends[0] + ends[1] + 1) // 2
    old = F.coalesce(F.col("doc_id") < F.lit(cut), F.lit(False))
    snapshot = build_snapshot(docs.filter(old), digests.filter(old))
    return dedup(snapshot, docs.filter(~old), digests.filter(~old))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``dedup_corpus`` keeps, all columns as they
    are. The dropped rows' ids and digest keys are joined to the texts (by a
    broadcast while they are few)."""
    verdicts = durable(dedup_corpus(docs).select("doc_id", F.xxhash64("text_sha256").alias("key"), "kept"),
                       "dedup-verdicts")
    dropped = durable(verdicts.filter("not kept").select("doc_id", "key").distinct(), "dedup-dropped")
    # A row repeated with its doc_id is both kept and dropped: one copy goes back.
    d, k = dropped.alias("d"), verdicts.filter("kept").alias("k")
    again = durable(d.join(k, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                           & (F.col("d.key") == F.col("k.key")), "left_semi"), "dedup-again")
    name = free_name(docs.columns, "_digest_key")
    tagged = docs.withColumn(name, F.xxhash64(text_digest(F.col("text"))))

    def same(right: str):
        return (F.col("t.doc_id").cast("long").eqNullSafe(F.col(f"{right}.doc_id"))
                & (F.col(f"t.{name}") == F.col(f"{right}.key")))

    kept = tagged.alias("t").join(broadcast_if_small(dropped).alias("x"), same("x"), "left_anti")
    if again.count():
        once = tagged.alias("t").join(broadcast_if_small(again).alias("y"), same("y"), "left_semi")
        kept = kept.unionByName(once.dropDuplicates(["doc_id", name]))
    return kept.drop(name)
