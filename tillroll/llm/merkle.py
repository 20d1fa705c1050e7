"""Merkle manifest of a table, with proofs by pointer jumping.

Every row is a leaf. Leaves are ordered inside their group, every ``ARITY``
consecutive nodes (a run) become their hash, until one node of the group is left,
its subroot. Subroots, ordered by group, give the root in the same way.

A proof of a leaf holds its siblings on each level. Proofs are made by pointer
jumping. Every node knows an ancestor and the sibling segments on the way to it:
at first its parent and its own siblings. In each round a node meets its
ancestor in a self-join, takes over that one's ancestor and appends its segments,
so the distance doubles until the root is reached: log2(depth) rounds.

What is bounded: a run holds at most ``ARITY`` nodes. The leaves of a run have the
same ancestors, so a leaf run jumps as one row. Near the root, many rows share an
ancestor: a node is copied once for every ``ROWS_PER_COPY`` leaf runs below it and
its descendants are dealt among the copies, which adds a few copies for a thousand
rows. Rows are numbered by a range sort, so a group of any size is spread. Digests
move as 32 bytes; texts are read once and never move.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .ordering import numbered

ARITY = 8
ROWS_PER_COPY = 256
#: The tree over the subroots; groups are numbered from 0.
TOP = -1
SEGMENT = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    """``-`` for null, else the byte length, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """The 32-byte digest of a row."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def hex_text(digests: Column) -> Column:
    """Lower-case hex of a binary column."""
    return F.lower(F.hex(digests))


def joined(digests: Column) -> Column:
    """An array of digests as one binary value."""
    return F.unhex(F.array_join(F.transform(digests, lambda d: F.hex(d)), ""))


def hash_of(digests: Column) -> Column:
    """H of an array of digests: over their hex texts, in order."""
    return F.unhex(F.sha2(hex_text(joined(digests)).cast("binary"), 256))


def siblings(digests: Column, index: Column) -> Column:
    """The run's digests before and after the one at ``index`` (from 0)."""
    return F.struct(joined(F.slice(digests, F.lit(1), index)).alias("left"),
                    joined(F.slice(digests, index + 2, F.lit(ARITY))).alias("right"))


def fold(leaf: Column, segments: Column) -> Column:
    """The root (hex) that a leaf digest and its sibling segments give."""
    return F.aggregate(segments, hex_text(leaf), lambda node, s: F.sha2(
        F.concat(hex_text(s["left"]), node, hex_text(s["right"])).cast("binary"), 256))


def proof_text(segments: Column) -> Column:
    """All siblings of a proof as hex text, level by level, left to right."""
    return F.array_join(F.transform(segments, lambda s: F.concat(
        hex_text(s["left"]), hex_text(s["right"]))), "")


@dataclass(frozen=True)
class Manifest:
    """Written tables of a manifest."""

    runs: DataFrame    # tree, pos, group_rows, members (pos, digest, and what the leaves carry)
    nodes: DataFrame   # inner nodes with ancestor and segment, as ``_pointers`` gives them
    root: str | None   # hex; None for an empty table


def _run(nodes: DataFrame, level: int) -> DataFrame:
    """Runs of ``ARITY`` consecutive nodes (tree, pos, n, digest, weight)."""
    return durable(
        nodes.groupBy("tree", "n", F.expr(f"pos div {ARITY}").alias("run"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "weight"))).alias("members"))
        .select("tree", "n", "run", "members", hash_of(F.col("members.digest")).alias("digest"),
                F.aggregate("members.weight", F.lit(0).cast("long"), lambda a, w: a + w).alias("weight")),
        f"merkle-level-{level}")


def _pointers(runs: DataFrame, level: int) -> DataFrame:
    """The nodes of ``runs`` with parent and siblings. Above the last run of a
    group is its subroot, a node of the top tree; above that of the top tree is
    the root, which has no row."""
    last = F.col("n") <= ARITY
    node = runs.select("*", F.explode("members").alias("m"))
    own = siblings(F.col("members.digest"), (F.col("m.pos") % ARITY).cast("int"))
    top_leaf = (F.col("tree") == TOP) & (F.lit(level) == 0)
    return node.select(
        "tree", F.lit(level).alias("level"), F.col("m.pos").alias("pos"), F.col("m.weight").alias("weight"),
        F.when(last & (F.col("tree") == TOP), F.lit(None)).when(last, TOP)
        .otherwise(F.col("tree")).cast("long").alias("up_tree"),
        F.when(last, 0).otherwise(level + 1).alias("up_level"),
        F.when(last, F.col("tree")).otherwise(F.col("run")).alias("up_pos"),
        F.col("weight").alias("up_weight"), F.array(own).cast(SEGMENT).alias("segment"),
        F.when(top_leaf, F.col("m.digest")).alias("subroot"))


def _climb(nodes: DataFrame, level: int, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Pointers of all levels from ``nodes`` (tree, pos, n, digest, weight; n: the
    nodes of the tree on this level, ``most`` at most) on, and the last node of
    each tree."""
    pointers, last = [], []
    while True:
        last.append(nodes.filter("n = 1"))
        if most <= 1:
            return pointers, reduce(DataFrame.unionByName, last)
        runs = _run(nodes.filter("n > 1"), level)
        pointers.append(_pointers(runs, level))
        nodes = runs.select("tree", F.col("run").alias("pos"), F.ceil(F.col("n") / ARITY).alias("n"),
                            "digest", "weight")
        most, level = -(-most // ARITY), level + 1


def build_manifest(leaves: DataFrame, group: str, order: list[str], carried: list[str]) -> Manifest:
    """The manifest of ``leaves`` (a written table with a binary ``digest``).

    Leaves are ordered by ``order`` inside ``group``, groups by their value, nulls
    first. ``order`` ends with a column that tells equal rows apart. ``carried``
    columns stay with the leaves. An empty table has no root.
    """
    placed = numbered(leaves, [group], order, "merkle-leaves", number_groups=True)
    members = F.array_sort(F.collect_list(F.struct("pos", "digest", *carried)))
    runs = durable(
        placed.groupBy(F.col("group_no").alias("tree"), F.expr(f"pos div {ARITY}").alias("pos"), "group_rows")
        .agg(members.alias("members"))
        .select("*", F.when(F.col("group_rows") == 1, F.col("members")[0]["digest"])
                .otherwise(hash_of(F.col("members.digest"))).alias("digest")), "merkle-leaf-runs")
    most, groups = runs.agg(F.max("group_rows"), F.max("tree") + 1).first()
    if most is None:
        return Manifest(runs, None, None)
    parents = runs.select("tree", "pos", F.ceil(F.col("group_rows") / ARITY).alias("n"), "digest",
                          F.lit(1).cast("long").alias("weight"))
    inner, subroots = _climb(parents, 1, -(-most // ARITY))
    tops = durable(subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"),
        F.lit(groups).cast("long").alias("n"), "digest", "weight"), "merkle-subroots")
    upper, root = _climb(tops, 0, groups)
    if groups == 1:
        upper = [tops.select(
            "tree", F.lit(0).alias("level"), "pos", "weight", F.lit(None).cast("long").alias("up_tree"),
            F.lit(0).alias("up_level"), F.lit(0).cast("long").alias("up_pos"),
            F.col("weight").alias("up_weight"), F.array().cast(SEGMENT).alias("segment"),
            F.col("digest").alias("subroot"))]
    nodes = durable(reduce(DataFrame.unionByName, inner + upper), "merkle-nodes")
    return Manifest(runs, nodes, root.first()["digest"].hex())


def _copies(weight: str) -> Column:
    return F.ceil(F.col(weight) / ROWS_PER_COPY).cast("int")


def _jump(table: DataFrame) -> DataFrame:
    """One round: every node that is not at the root yet takes over its
    ancestor's ancestor and segments."""
    ahead = table.filter("up_tree is not null").select("*", F.pmod(
        F.xxhash64("tree", "level", "pos"), _copies("up_weight")).cast("int").alias("copy")).alias("a")
    met = table.filter(f"level > 0 or tree = {TOP}").select("*", F.explode(
        F.sequence(F.lit(0), _copies("weight") - 1)).alias("copy")).alias("m")
    on = ((F.col("a.up_tree") == F.col("m.tree")) & (F.col("a.up_level") == F.col("m.level"))
          & (F.col("a.up_pos") == F.col("m.pos")) & (F.col("a.copy") == F.col("m.copy")))
    moved = ahead.join(met, on).select(
        "a.tree", "a.level", "a.pos", "a.weight", "m.up_tree", "m.up_level", "m.up_pos", "m.up_weight",
        F.concat("a.segment", "m.segment").alias("segment"),
        F.coalesce("a.subroot", "m.subroot").alias("subroot"))
    return durable(table.filter("up_tree is null").unionByName(moved), "merkle-jump")


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: its digest and carried columns, subroot, and ``proof``:
    the sibling segments (left, right) from its own level up to the root."""
    last = F.col("group_rows") <= ARITY
    runs = manifest.runs.select(
        "tree", F.lit(0).alias("level"), "pos", F.lit(1).cast("long").alias("weight"),
        F.when(last, TOP).otherwise(F.col("tree")).cast("long").alias("up_tree"),
        F.when(last, 0).otherwise(1).alias("up_level"),
        F.when(last, F.col("tree")).otherwise(F.col("pos")).alias("up_pos"),
        F.lit(1).cast("long").alias("up_weight"),
        F.array().cast(SEGMENT).alias("segment"), F.lit(None).cast("binary").alias("subroot"))
    table = durable(manifest.nodes.unionByName(runs), "merkle-jump")
    while not table.filter(f"level = 0 and tree <> {TOP} and up_tree is not null").isEmpty():
        table = _jump(table)
    paths = table.filter(f"level = 0 and tree <> {TOP}").select("tree", "pos", "segment", "subroot")
    leaf = manifest.runs.join(paths, ["tree", "pos"]).select("*", F.explode("members").alias("m"))
    own = F.array(siblings(F.col("members.digest"), (F.col("m.pos") % ARITY).cast("int"))).cast(SEGMENT)
    return leaf.select("m.*", "subroot", F.when(F.col("group_rows") == 1, F.col("segment"))
                       .otherwise(F.concat(own, "segment")).alias("proof")).drop("pos")


def lower_cased(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaf digests of ``docs`` (doc_id, source, lang, n_chars, text), with
    ``suspect``: the digest after tampering (A-Z of the text lower-cased) where 3
    divides the CRC-32 of the id, else null. A null id or text stays as it is."""
    def digest(text: Column) -> Column:
        return leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return durable(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        digest(F.col("text")).alias("digest"),
        F.when(hit, digest(lower_cased(F.col("text")))).alias("suspect"),
        F.monotonically_increasing_id().alias("row_tag")), "merkle-documents")


def verify_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs``, and every (partly tampered) row checked by its
    proof: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    One tree for each ``lang`` (null first, then by bytes). Nulls in any column
    have a form of their own, so they differ from empty texts. Rows that repeat a
    doc_id in a language are ordered by their leaf; equal rows are interchangeable.
    Null ids come first and are not tampered with. An empty table gives an empty
    result. Other columns are not looked at.
    """
    manifest = build_manifest(document_leaves(docs), "lang", ["doc_id", "digest", "row_tag"],
                              ["doc_id", "suspect"])
    if manifest.root is None:
        return manifest.runs.sparkSession.createDataFrame(
            [], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                "folded_root string, verified boolean")
    checked = proofs(manifest).select(
        "doc_id", hex_text(F.col("digest")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        F.lit(manifest.root).alias("root"),
        F.sha2(proof_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("suspect", "digest"), F.col("proof")).alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
