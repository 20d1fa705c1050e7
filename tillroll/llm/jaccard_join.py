"""Exact n-gram Jaccard join with signature trees.

Which documents are linked by a similarity of ``percent`` / 100 or more, and
the components of those links. No link between components is lost:

1. Equal sets are one class. Only one representative of a class goes on.
2. Two sets that are similar enough share a token among each one's first
   n - ceil(percent n / 100) + 1 tokens, in any order that all sets use. The
   order is by hash, with tokens that very many prefixes hold last, so a passage
   that many documents share seldom leads a prefix.
3. Every token group compares its members with one member of it (its leader, by
   a hash of both), which is linear in the group. The links found connect most
   of each group of near copies.
4. A token group that still holds several components goes to the signature
   trees. Groups are dealt into units of a bounded size; a larger group is cut
   into blocks and its pairs of blocks. Each unit builds a tree and traverses
   it against itself; nodes whose pairs are all connected already, share no
   token, or differ too much in size are dropped, and a parity sketch bounds
   the symmetric difference of the pairs left.
5. Candidates are verified on the whole texts.

Links found in 3 and 5 give the components, which are all that the operator
gives: pairs that are connected already are not looked at, so the links found
are neither all links nor a count of them. Only documents in candidate pairs
send their texts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .bpe_codec import chunks, small_batches
from .components import components
from .shingles import shingle_set
from .signature_tree import Parities, candidates, most_difference, parity_sketch
from .sized import broadcast_if_small, first_rows, free_name

UNIT = 4096                # rows of a unit of trees, and of a block of a large group
HEAVY_SHARE = 4000         # a token in more than 1 / HEAVY_SHARE of the prefixes is heavy
HEAVY_LEAST = 64
HEAVY_MOST = 500_000       # tokens put last (4 MB); the others keep their hash order
SHARED_TOKENS = 2_000_000  # most 8-byte tokens that are broadcast; beyond, a shuffle join
FIRST_PARTNERS = 2         # leaders verified for a document before the trees
FEATURES = "doc_id long, tag long, mark binary, n long, key binary, tokens array<long>, sketch binary"


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sketch_bits(n: int, percent: int) -> int:
    wide = 8 * (100 - percent) * n // percent
    return min(1 << 14, max(512, 1 << max(0, wide - 1).bit_length()))


def _set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _mark(text: Column) -> Column:
    """128 bits that tell texts apart; with the doc_id they name a row."""
    return F.unhex(F.md5(text.cast("binary")))


def set_features(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: mark of its text, size and 128-bit key of its set,
    twice its prefix in hash order, and a parity sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = [shingle_set(t, words) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("tag"), part.column("mark"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[:2 * prefix_length(len(s), percent)].view(np.int64) if len(s) else None
                              for s in sets], pa.list_(pa.int64())),
                    pa.array([parity_sketch(s, _sketch_bits(len(s), percent)) if len(s) else None
                              for s in sets], pa.binary())],
                    ["doc_id", "tag", "mark", "n", "key", "tokens", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.monotonically_increasing_id().alias("tag"), _mark(F.col("text")).alias("mark"),
                       "text").mapInArrow(run, FEATURES)


def _heavy_last(tokens: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """A set in prefix order."""
    held = np.isin(tokens, heavy)
    return np.concatenate([tokens[~held], tokens[held]])


def _prefixes(docs: DataFrame, reps: DataFrame, total: int, words: int, percent: int) -> DataFrame:
    """(token, node, n): each representative's prefix, without tokens that no
    other one holds."""
    spark = docs.sparkSession
    short = F.expr("slice(tokens, 1, cast(ceil(size(tokens) / 2) as int))")
    often = max(HEAVY_LEAST, total // HEAVY_SHARE)
    seen = durable(reps.select(F.explode(short).alias("token")).groupBy("token").count()
                   .filter("count > 1"), "join-seen")
    # Any order that all sets share gives the same links, so it is no loss if only the
    # most frequent tokens come last: the broadcast has a bound of 8 bytes each.
    heavy = (seen.filter(F.col("count") > often).orderBy(F.desc("count"), "token").limit(HEAVY_MOST)
             .select("token").collect())
    shipped = spark.sparkContext.broadcast(np.array(sorted(r["token"] for r in heavy), np.int64))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, out, fresh = batch.column("n").to_pylist(), [], []
            for n, own in zip(sizes, batch.column("tokens")):
                own = own.values.to_numpy(zero_copy_only=False)
                p = prefix_length(n, percent)
                light = own[~np.isin(own, shipped.value)]
                if len(light) >= p:
                    out.append(light[:p])
                else:
                    # All tokens are at hand, or the text has to be read again.
                    out.append(_heavy_last(own, shipped.value)[:p] if len(own) == n else None)
                fresh.append(None if out[-1] is None else np.setdiff1d(out[-1], own[:p]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), pa.array(out, pa.list_(pa.int64())),
                 pa.array(fresh, pa.list_(pa.int64()))], ["node", "n", "prefix", "fresh"])

    ordered = durable(reps.select("node", "n", "tokens").mapInArrow(
        order, "node long, n long, prefix array<long>, fresh array<long>"), "join-prefixes")
    rows = ordered.filter("prefix is not null").select("node", "n", "prefix", "fresh")
    again = reps.join(ordered.filter("prefix is null").select("node"), "node")
    if ordered.filter("prefix is null").count():
        def reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, "text"):
                    sets = [shingle_set(t, words) for t in part.column("text").to_pylist()]
                    out = [_heavy_last(s.view(np.int64), shipped.value)[:prefix_length(len(s), percent)]
                           for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node"), pa.array([len(s) for s in sets], pa.int64()),
                         pa.array(out, pa.list_(pa.int64())), pa.array(out, pa.list_(pa.int64()))],
                        ["node", "n", "prefix", "fresh"])

        texts = node_texts(docs, again.select("node", "doc_id", "mark"))
        rows = rows.unionByName(durable(texts.mapInArrow(
            reread, "node long, n long, prefix array<long>, fresh array<long>"), "join-reread"))
    # Tokens that two prefixes held before, or that came in since: all others
    # are alone in their group.
    shared = durable(seen.select("token").unionByName(
        rows.select(F.explode("fresh").alias("token"))).distinct(), "join-shared")
    return rows.select(F.explode("prefix").alias("token"), "node", "n").join(
        broadcast_if_small(shared, SHARED_TOKENS), "token", "left_semi")


def _texts_met(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    wanted = broadcast_if_small(durable(nodes, "join-nodes"))
    d, w = docs.withColumn("mark", _mark(F.col("text"))).alias("d"), wanted.alias("w")
    return d.join(w, (F.col("d.mark") == F.col("w.mark")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))).select(
        "w.node", "d.text")


def node_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of representatives (node, doc_id, mark). Id and mark name the
    row's text, so only rows that repeat both meet a representative more than once."""
    return _texts_met(docs, nodes).groupBy("node").agg(F.any_value("text").alias("text"))


def verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of representatives that are linked, by their texts."""
    pairs = durable(pairs, "join-pairs")
    if not pairs.count():
        return pairs
    involved = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()
    texts = durable(node_texts(docs, reps.select("node", "doc_id", "mark").join(involved, "node")), "join-texts")
    both = (pairs.join(texts.withColumnsRenamed({"node": "a", "text": "a_text"}), "a")
            .join(texts.withColumnsRenamed({"node": "b", "text": "b_text"}), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, keep = {}, []

            def own(node: int, text: str) -> np.ndarray:
                if node not in known:
                    if len(known) >= 256:
                        known.clear()
                    known[node] = shingle_set(text, words)
                return known[node]

            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("a", "b", "a_text", "b_text")}
                x, y = own(row["a"], row["a_text"]), own(row["b"], row["b_text"])
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return durable(both.select("a", "b", "a_text", "b_text").mapInArrow(check, "a long, b long"),
                   "join-links")


def _leader_pairs(prefixes: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of a representative and a token group's leader that may be linked;
    of each representative the ``FIRST_PARTNERS`` with the least difference."""
    leaders = prefixes.groupBy("token").agg(
        F.min(F.struct(F.xxhash64("node", "token"), F.col("node").alias("leader"),
                       F.col("n").alias("leader_n"))).alias("l"))
    met = (prefixes.join(leaders.select("token", "l.leader", "l.leader_n"), "token")
           .filter((F.col("node") != F.col("leader"))
                   & (F.col("n") * 100 >= F.col("leader_n") * percent)
                   & (F.col("leader_n") * 100 >= F.col("n") * percent))
           .select("node", "leader").distinct())
    sketches = reps.select("node", "n", "sketch")
    told = (met.join(sketches, "node")
            .join(sketches.withColumnsRenamed({"node": "leader", "n": "leader_n", "sketch": "leader_sketch"}),
                  "leader"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            count = batch.num_rows
            parity = Parities(batch.column("sketch").to_pylist() + batch.column("leader_sketch").to_pylist())
            least = parity.least_difference(np.arange(count), np.arange(count) + count)
            most = most_difference(batch.column("n").to_numpy(zero_copy_only=False),
                                   batch.column("leader_n").to_numpy(zero_copy_only=False), percent)
            kept = batch.append_column("least", pa.array(least)).filter(pa.array(least <= most))
            yield kept.select(["node", "leader", "least"])

    close = told.mapInArrow(near, "node long, leader long, least long")
    best = close.groupBy("node").agg(F.slice(F.array_sort(F.collect_set(
        F.struct("least", F.xxhash64("leader"), "leader"))), 1, FIRST_PARTNERS).alias("best"))
    return (best.select("node", F.explode("best.leader").alias("leader"))
            .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
            .distinct())


def _unconnected(prefixes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Prefix rows (with ``component``) of token groups in which a document of
    a similar size belongs to another component. Sizes fall into classes as wide
    as the similarity allows, so only neighbouring classes matter."""
    rows = (prefixes.join(found, "node", "left")
            .select("token", "node", "n", F.coalesce("component", "node").alias("component"),
                    F.floor(F.ln(F.col("n")) / math.log(100 / percent) + 1e-9).alias("class")))
    groups = rows.groupBy("token", "class").agg(F.min("component").alias("low"),
                                                F.max("component").alias("high"))
    mixed = (groups.select("token", "low", "high", F.explode(F.array(
        F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"))
        .groupBy("token", "class").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .filter("low <> high").select("token", "class"))
    return rows.join(mixed, ["token", "class"], "left_semi").drop("class")


def _tree_pairs(rows: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of the token groups' rows, by signature trees."""
    rows = durable(rows, "join-rows")
    units = max(1, -(-rows.count() // UNIT))
    sizes = rows.groupBy("token").agg((F.floor((F.count(F.lit(1)) - 1) / UNIT) + 1).alias("blocks"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks"))
    dealt = (rows.join(sizes, "token").select("*", own.alias("block"))
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    whole = F.col("blocks") == 1
    placed = (dealt.select(
        F.when(whole, F.pmod("token", F.lit(units))).otherwise(F.col("token")).alias("unit"),
        F.when(whole, F.lit(-1)).otherwise(low * (1 << 31) + high).cast("long").alias("cut"),
        (~whole & (F.col("block") > F.col("other"))).cast("byte").alias("side"),
        "token", "node", F.col("n").cast("int").alias("n"), "component")
        .join(reps.select("node", "sketch"), "node"))

    def traverse(table: pa.Table) -> pa.Table:
        def column(name: str) -> np.ndarray:
            return table.column(name).to_numpy().astype(np.int64)

        cut = table.column("cut")[0].as_py()
        a, b = candidates(column("token"), column("node"), column("n"), column("component"),
                          column("side"), table.column("sketch").to_pylist(), percent,
                          cut >= 0 and cut >> 31 != cut & ((1 << 31) - 1))
        return pa.table({"a": a, "b": b})

    return placed.groupBy("unit", "cut").applyInArrow(traverse, "a long, b long").distinct()


def _documents(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, mark, n, component_id, alone and kept of every row of ``docs``.

    Of each component the row that comes first by doc_id (null last), set key
    and mark is kept, and every row without words. ``alone`` is whether no other
    row has the row's set. Rows with the same doc_id and mark are all kept or
    all not.
    """
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = durable(set_features(docs, words, percent), "join-sets")
    classes = durable(features.filter("n > 0").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tag"))).alias("first"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("least"),
        F.count(F.lit(1)).alias("rows"))
        .select("key", F.col("first.tag").alias("node"), F.struct(
            "least.no_id", "least.doc_id", "key", "least.mark").alias("least"), "rows"), "join-classes")
    chosen = broadcast_if_small(durable(classes.select(F.col("node").alias("tag")), "join-chosen"))
    whole = (features.join(chosen, "tag", "left_semi").withColumnRenamed("tag", "node"))
    prefixes = durable(_prefixes(docs, whole, classes.count(), words, percent), "join-tokens")
    reps = durable(whole.select("node", "doc_id", "mark", "n", "sketch"), "join-reps")
    tried = durable(_leader_pairs(prefixes, reps, percent), "join-tried")
    links = verified(docs, reps, tried, words, percent)
    rest = _unconnected(prefixes, components(links), percent)
    # Written, so that a pair is one row before the join: units that share several of
    # its tokens each find it, and Spark would move the join below the distinct.
    found = durable(_tree_pairs(rest, reps, percent), "join-found")
    more = found.join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(verified(docs, reps, more, words, percent))
    joined = components(links).join(classes.select("node", "least"), "node")
    least = joined.groupBy("component").agg(F.min("least").alias("stays"))
    final = durable(joined.join(least, "component").select("node", "stays"), "join-components")
    of_class = (classes.join(final, "node", "left")
                .select("key", "rows", F.coalesce("stays", "least").alias("stays")))
    f, c = features.select("doc_id", "mark", "n", "key").alias("f"), of_class.alias("c")
    first = (F.col("f.doc_id").eqNullSafe(F.col("c.stays.doc_id")) & (F.col("f.key") == F.col("c.stays.key"))
             & (F.col("f.mark") == F.col("c.stays.mark")))
    return f.join(c, F.col("f.key") == F.col("c.key"), "left").select(
        "f.doc_id", "f.mark", "f.n",
        F.when(F.col("f.n") == 0, F.col("f.doc_id")).otherwise(F.col("c.stays.doc_id")).alias("component_id"),
        ((F.col("f.n") == 0) | (F.col("c.rows") == 1)).alias("alone"),
        ((F.col("f.n") == 0) | first).alias("kept"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach, the own one included.
    A text without words (null included) has the empty set and is linked with
    nothing. Repeated rows and rows that repeat a doc_id are documents of their
    own; null ids are no component_id unless the whole component has none. An
    empty table gives an empty result. Long texts are read whole. Other columns
    are not looked at.
    """
    return _documents(docs, words, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they are: the one
    with the smallest doc_id (null only if the component has no id), then the
    smallest set key and text digest. Rows without words are linked with nothing
    and all stay. Rows are told apart by doc_id and text; of rows that repeat
    both, the one whose other columns come first as JSON stays.
    """
    found = durable(_documents(docs, words, percent), "join-documents")
    out = broadcast_if_small(durable(
        found.filter("not kept").select("doc_id", "mark").distinct(), "join-dropped"))
    again = durable(found.filter("kept and not alone").groupBy("doc_id", "mark").count()
                    .filter("count > 1").select("doc_id", "mark"), "join-again")
    name = free_name(docs.columns, "_text_mark")
    tagged = docs.withColumn(name, _mark(F.col("text")))

    def same(right: str) -> Column:
        return (F.col("d.doc_id").cast("long").eqNullSafe(F.col(f"{right}.doc_id"))
                & (F.col(f"d.{name}") == F.col(f"{right}.mark")))

    kept = tagged.alias("d").join(out.alias("x"), same("x"), "left_anti")
    if again.count():
        y = broadcast_if_small(again).alias("y")
        once = first_rows(kept.alias("d").join(y, same("y"), "left_semi"), ["doc_id", name])
        kept = kept.alias("d").join(y, same("y"), "left_anti").unionByName(once)
    return kept.drop(name)
