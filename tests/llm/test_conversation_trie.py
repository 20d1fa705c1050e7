"""Conversation trie: brute force, double arrays, packs and segments, odd rows, SQL."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import sf  # noqa: F401
from tillroll.llm import conversation_trie
from tillroll.llm.double_array import DoubleArray

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for r in rows:
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            told = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[r.conv_id].append(((r.turn is not None, r.turn or 0, told), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = own.get(first, [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            kids[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1]) if path else 0
    return sorted([(min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode())
                    .hexdigest()) for p, m in nodes.items()], key=str)


def check(conversations, **parameters):
    got = sorted((tuple(r) for r in conversation_trie.prefix_trie(conversations, **parameters).collect()), key=str)
    expected = brute(conversations.collect())
    assert got == expected
    return got


@pytest.fixture(scope="module")
def conversations(spark, sf):
    return spark.read.parquet(f"{sf}/conversations.parquet")


@pytest.mark.parametrize("size,pack", [(512, 60_000), (2, 40)])
def test_brute_force(conversations, size, pack):
    check(conversations, size=size, pack_turns=pack)


def test_odd_rows(spark):
    rows = [(0, None, "user", "Hello"), (0, 1, None, None), (0, 1, "", ""), (0, 1, None, None),
            (0, 2, "user", "x" * 50_000), (0, 3, "user", "日本"), (0, 4, "a", "b"), (0, 5, "ab", ""),
            (None, 1, "user", "no conversation"), (-1, 0, "user", "Hello"), (-100, 0, "user", "Hello"),
            (-150, 1, "user", "other"), (205, 0, "user", "left without turns"), (305, 0, "u", "gone"),
            (1, 0, "user", "Hello"), (1, 0, "user", "Hello"), (2, 7, "user", "Hello"), (2, 8, "", "")]
    odd = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("x")).withColumn("depth", F.lit(1))
    got = check(odd)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)
    check(odd, size=2, pack_turns=3)
    assert conversation_trie.prefix_trie(odd.limit(0)).count() == 0


def test_copies_common_turns_and_a_long_conversation(spark):
    """A third of all conversations are equal, a third share the first turn, and
    one conversation holds a third of all turns."""
    n = 300
    c = F.col("id") + 1000
    short = spark.range(n).select(
        c.alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("turn"), F.col("id")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.lit("user").alias("role"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("same "), F.col("turn")))
        .when((F.col("id") % 3 == 1) & (F.col("turn") == 0), F.lit("common first turn"))
        .otherwise(F.concat(F.col("id") % 50, F.lit(" says "), F.col("turn"))).alias("text"))
    long = spark.range(1200).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"),
        F.concat(F.lit("line "), F.col("id") % 11).alias("text"))
    both = short.unionByName(long).unionByName(long.withColumn("conv_id", F.lit(9).cast("long")).filter("turn < 300"))
    check(both, size=256, pack_turns=500)


def test_ids_that_end_at_one_node(spark):
    """Very many ids at a node, in small Arrow batches over many partitions."""
    rows = spark.range(3000).select((F.col("id") * 100).alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                                    F.lit("user").alias("role"), F.lit("hello").alias("text"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed,kinds,count", [(1, 3, 200), (2, 500, 400), (3, 40, 1), (4, 1, 30)])
def test_double_array_holds_exactly_its_sequences(seed, kinds, count):
    rng = np.random.default_rng(seed)
    made = sorted({tuple(rng.integers(0, kinds, rng.integers(0, 9)).tolist()) for _ in range(count)})
    lengths = np.array([len(s) for s in made], np.int64)
    trie = DoubleArray(np.array([c for s in made for c in s], np.int64), lengths)
    paths = {}
    for depth, alive, state in trie.walk():
        for i, s in zip(alive.tolist(), state.tolist()):
            assert paths.setdefault(s, made[i][:depth]) == made[i][:depth]
    prefixes = {s[:d] for s in made for d in range(len(s) + 1)}
    assert set(paths.values()) == prefixes and len(paths) == len(prefixes)
    assert int((trie.check >= 0).sum()) == len(prefixes) - 1
    for s, path in paths.items():
        for c in range(kinds):
            at = trie.base[s] + c
            found = 0 < at < len(trie.check) and trie.check[at] == s
            assert found == (path + (c,) in prefixes)
