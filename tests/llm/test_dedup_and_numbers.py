"""Exact dedup, fuse filters, sharding, mixing: brute force and odd rows."""

import hashlib
import math
import pathlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import document_rows, documents, no_documents, odd_documents, sf  # noqa: F401
from tillroll.llm import exact_dedup, fuse_filter, mixing, sharding


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 5000, 60_000])
def test_fuse_filter_has_no_false_negative(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
    made = fuse_filter.build(np.concatenate([keys, keys[:5]]))
    assert fuse_filter.contains(made, keys).all()
    other = rng.integers(0, 2 ** 64, 20_000, dtype=np.uint64)
    assert fuse_filter.contains(made, other).mean() < 0.01
    if n >= 5000:
        assert len(made) < 1.4 * n + 100


def check_dedup(rows, texts):
    groups = defaultdict(list)
    for doc_id, text in texts:
        groups[hashlib.sha256(lowered(text).encode()).hexdigest()].append(doc_id)
    assert len(rows) == len(texts)
    kept = defaultdict(int)
    for r in rows:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert all(n == 1 for n in kept.values()) and len(kept) == len(groups)


def test_dedup_brute_force(documents, document_rows):
    rows = exact_dedup.dedup_corpus(documents).collect()
    check_dedup(rows, [(r.doc_id, r.text) for r in document_rows])
    assert {r.via for r in rows} == {"snapshot", "match", "batch"}


def test_dedup_odd_rows(odd_documents, no_documents):
    texts = [(r.doc_id, r.text) for r in odd_documents.collect()]
    check_dedup(exact_dedup.dedup_corpus(odd_documents).collect(), texts)
    assert exact_dedup.dedup_corpus(no_documents).count() == 0
    out = exact_dedup.distinct_documents(odd_documents)
    assert out.columns == odd_documents.columns
    assert sorted(lowered(r.text) for r in out.collect()) == sorted({lowered(t) for _, t in texts})


def test_screen_lets_only_positives_through(documents):
    half = documents.filter("doc_id % 2 = 0")
    snapshot = exact_dedup.build_snapshot(half)
    batch = exact_dedup._groups(exact_dedup.digest_table(documents.filter("doc_id % 2 = 1"), "t"))
    passed = {r.text_sha256 for r in exact_dedup.screen(snapshot, batch).collect()}
    inside = {r.text_sha256 for r in snapshot.groups.collect()}
    every = {r.text_sha256 for r in batch.collect()}
    assert every & inside <= passed and len(passed - inside) <= 0.05 * len(every) + 2


def feistel(x, n, key):
    a, b = sharding.rectangle(n)

    def once(x):
        u, v, mu, mv = x // b, x % b, a, b
        for i in range(sharding.ROUNDS):
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), 42)
            k = key * sharding.ROUNDS + i
            h = xxhash.xxh64_intdigest(k.to_bytes(8, "little", signed=True), h)
            h -= (h >> 63) << 64
            u, v, mu, mv = v, (u + h % mu) % mu, mv, mu
        return u * b + v

    x = once(x)
    while x >= n:
        x = once(x)
    return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_feistel_is_a_permutation(spark, n):
    got = [r.p for r in spark.range(n).select(sharding.feistel(F.col("id"), n, 5).alias("p")).collect()]
    assert sorted(got) == list(range(n))
    assert sorted(feistel(i, n, 5) for i in range(n)) == list(range(n))
    rows = spark.range(n).select("id", sharding.feistel(F.col("id"), n, 5).alias("p")).collect()
    assert all(r.p == feistel(r.id, n, 5) for r in rows)


def check_shards(rows, texts, shards, key):
    n = len(texts)
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted(r.row_no for r in rows) == list(range(n))
    for r in rows:
        at = feistel(r.row_no, n, key)
        assert (r.shard, r.slot, r.law, r.grown_shard) == (at % shards, at // shards, "rows", None)


def test_sharding(documents, document_rows, odd_documents, no_documents):
    rows = sharding.shard_rows(documents).collect()
    check_shards(rows, [(r.doc_id, r.text) for r in document_rows], 40, 20_240)
    again = sharding.shard_rows(documents.repartition(5, "lang")).collect()
    assert sorted(rows) == sorted(again)
    odd = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rows = sharding.shard_rows(odd_documents, shards=3).collect()
    assert len(rows) == len(odd) and sorted(r.row_no for r in rows) == list(range(len(odd)))
    assert sharding.shard_rows(no_documents).count() == 0


def test_sharding_of_a_row_repeated_many_times(spark):
    rows = sharding.shard_rows(spark.range(150_000).select(F.lit(1).alias("doc_id"), F.lit("a").alias("text")))
    spread = rows.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("s"),
                                       F.max("slot").alias("m")).collect()
    assert len(spread) == 40 and all(r.n == r.s == r.m + 1 == 3750 for r in spread)


def water_fill(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full, rest = {}, set(), share * sum(sizes.values())
    while True:
        openw = sum(w[s] for s in names if s not in full)
        left = rest - sum(most * sizes[s] for s in full)
        over = {s for s in names if s not in full and left * w[s] / openw > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in full else left * w[s] / openw for s in names}
        full |= over


def check_mix(rows, texts):
    words = {}
    sizes = defaultdict(int)
    for doc_id, source, text in texts:
        n = len((text or "").encode().split())
        sizes[source] += n
    target = water_fill(sizes, mixing.WEIGHTS, 1.5, 2)
    taken = defaultdict(int)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.first_words + r.second_words
        assert (r.first_at is None) == (r.first_words == 0)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6
    return words


def test_mixing(documents, document_rows, odd_documents, no_documents):
    rows = mixing.mix(documents).collect()
    check_mix(rows, [(r.doc_id, r.source, r.text) for r in document_rows])
    assert sorted(rows) == sorted(mixing.mix(documents.repartition(7)).collect())
    check_mix(mixing.mix(odd_documents).collect(),
              [(r.doc_id, r.source, r.text) for r in odd_documents.collect()])
    assert mixing.mix(no_documents).count() == 0


def test_schedule_is_inverted(spark):
    knots = ((0.0, 0.2), (0.3, 2.0), (0.6, 0.0), (1.0, 1.0))

    def area(t):
        out = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            d = min(max(t - t0, 0.0), t1 - t0)
            out += d * (w0 + w0 + (w1 - w0) * d / (t1 - t0)) / 2
        return out

    shares = [i / 50 for i in range(51)]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    for r in df.select("s", mixing.inverse_demand(F.col("s"), knots).alias("t")).collect():
        assert math.isclose(area(r.t), r.s * area(1.0), abs_tol=1e-9)


def test_mixing_equal_rows(spark):
    """Equal rows are one row of the windows, each is still placed, and its copies
    are made in runs."""
    n = 9000
    docs = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the same few words").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
        F.when(F.col("id") % 5 > 0, "s").alias("source"))
    check_mix(mixing.mix(docs).collect(), [(r.doc_id, r.source, r.text) for r in docs.collect()])
    group = spark.createDataFrame([("k", 10_000, 7), ("l", 1, 8)], "order_key string, copies long, x int")
    copies = mixing.each_copy(group)
    assert sorted((r.order_key, r.copy, r.x) for r in copies.collect()) == [
        *[("k", i, 7) for i in range(10_000)], ("l", 0, 8)]
    assert mixing.mixed_documents(docs.repartition(7)).groupBy("text").count().count() > n / 3


def test_mixed_documents_are_whole_and_in_order(documents, document_rows, odd_documents):
    texts = {r.doc_id: r.text for r in document_rows}
    out = mixing.mixed_documents(documents)
    assert out.columns == documents.columns
    rows = out.collect()
    assert all(texts[r.doc_id] == r.text for r in rows)
    mixed = {r.doc_id: r for r in mixing.mix(documents).collect()}
    reads = defaultdict(int)
    for r in rows:
        reads[r.doc_id] += 1
    for i, r in mixed.items():
        want = sum(w > 0 and 2 * w >= r.size for w in (r.first_words, r.second_words))
        assert reads[i] == want
    assert mixing.mixed_documents(odd_documents).columns == odd_documents.columns


def test_mixed_documents_place_every_repeat(spark):
    rows = [(i % 40 if i % 3 else None, f"text {i % 40} " + "word " * (i % 7), "abc"[i % 5 % 3], i)
            for i in range(240)]
    rows += [(1, "same words here", s, n) for n, s in enumerate(["a", "b", None, "b", "a", "c"])]
    schema = "doc_id long, text string, source string, n int"
    want = defaultdict(int)
    for r in mixing.mix(spark.createDataFrame(rows, schema)).collect():
        want[r.order_key, r.source] += sum(w > 0 and 2 * w >= r.size for w in (r.first_words, r.second_words))
    seen = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schema).repartition(3)
        out = mixing.mixed_documents(df)
        assert out.columns == df.columns
        key = mixing.order_key(F.col("doc_id"), F.col("text")).alias("key")
        got = defaultdict(int)
        for r in out.select(key, "source").collect():
            got[r.key, r.source] += 1
        assert dict(got) == {k: n for k, n in want.items() if n}
        seen.append(sorted((tuple(r) for r in out.collect()), key=str))
    assert seen[0] == seen[1] and set(seen[0]) <= set(rows)


@pytest.mark.parametrize("old", [0, 1])
def test_screen_deals_a_large_batch_over_more_groups(spark, monkeypatch, old):
    """A snapshot of no or one text (one outlying small id) has one filter, but
    the batch's digests do not all meet it in one group."""
    monkeypatch.setattr(exact_dedup, "KEYS_PER_BUCKET", 16)
    rows = [(-10 ** 12, "text 5")][:old] + [(None if not old else i, f"text {i % 400}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    def contains(made, keys):
        assert len(keys) <= 64
        return fuse_filter.contains(made, keys)

    monkeypatch.setattr(exact_dedup, "fuse_filter", type("Bounded", (), {
        "contains": staticmethod(contains), "build": staticmethod(fuse_filter.build)}))
    check_dedup(exact_dedup.dedup_corpus(df).collect(), rows)


@pytest.mark.parametrize("module", ["url_filter", "mixing", "sharding", "numbering", "ordering", "sized"])
def test_native_operators_use_no_python_worker(module):
    source = pathlib.Path(mixing.__file__).with_name(f"{module}.py").read_text()
    assert not re.search(r"\budf\(|\bpandas\b|\b[Aa]rrow|InArrow|InPandas|\.rdd\b|mapPartitions|numpy", source)
