"""Top-k search, Jaccard join, components and the pipeline: brute force."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF01
from llm_fixtures import document_rows, documents, no_documents, odd_documents, sf  # noqa: F401
from oracle_compare import compare, duck
from tillroll.llm import (components, jaccard_join, mixing, oracle, queries, signature_tree, shingles,
                          topk, toxicity)


@pytest.mark.parametrize("name", sorted(oracle.registry()))
def test_matches_oracle(spark, name):
    assert not compare(spark, name, queries.registry()[name], oracle.registry()[name], SF01, duck(SF01))


def test_registered():
    names = {n.split("_")[0] for n in queries.registry()}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert set(queries.registry()) | {"pipeline"} <= set(entry.queries())


def brute_top_k(rows, k):
    """Of all (id, vector) rows, repeated ones included, as the SQL has it."""
    out = []
    for q in {i for i, _ in rows if i % 20 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for p, v in rows if p == q for i, w in rows if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["ties", "few", "mixed", "large"])
def test_top_k_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "CHUNK", 16)
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "SEEDS", 32)
    rng = random.Random(kind)
    n = {"few": 9}.get(kind, 260)
    size = {"large": 2 ** 28}.get(kind, 3)
    vectors = {i: [rng.randint(-size, size) for _ in range(6 if kind != "mixed" else rng.randint(0, 6))]
               for i in range(n)}
    if kind == "ties":
        vectors |= {i: [1, 1, 1, 0, 0, 0] for i in range(100, 200)}
    rows = [(i, v, "x", 1) for i, v in vectors.items()]
    rows += [(None, [1, 2], "x", 1), (20_000, None, "x", 1), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>, rank string, score int").repartition(4)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 7)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute_top_k(
        [*vectors.items(), (0, vectors[0])], 7)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_broadcasts_no_vectors(spark, monkeypatch):
    """A join of blocks with chunks was planned as a broadcast of blocks x chunks whole blocks."""
    for name, value in (("CHUNK", 16), ("BLOCK", 4), ("SEEDS", 32)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(5)
    rows = [(i, [rng.randint(-9, 9) for _ in range(6)]) for i in range(600)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") % 20 == 0, 7)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute_top_k(rows, 7)


@pytest.mark.parametrize("held, most", [(48, 3), (600, 5), (1 << 23, 2048)])
def test_top_k_units(spark, monkeypatch, held, most):
    """Several groups, stripes and units in a partition, lengths of all sizes, repeated ids."""
    for name, value in (("CHUNK", 16), ("BLOCK", 4), ("SEEDS", 24), ("SPREAD", 24), ("WORK", 1500),
                        ("GRID", 7), ("HELD", held), ("MOST_PARTS", most)):
        monkeypatch.setattr(topk, name, value)
    rng = random.Random(held)
    rows = [(i % 380, [rng.randint(-9, 9) * (1 + 4000 // (i + 1)) for _ in range(6)]) for i in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 7)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute_top_k(rows, 7)


def test_packed_values_are_narrow():
    for low, high, size in ((0, 0, 1), (-128, 127, 1), (0, 128, 2), (-129, 0, 2), (-2 ** 31, 2 ** 31 - 1, 4),
                            (0, 2 ** 31, 8), (-2 ** 63, 2 ** 63 - 1, 8)):
        x = np.array([[low, high], [0, 0]], np.int64)
        ids, back = topk._unpack(np.array([7, 9]).tobytes(), topk._narrow(x).tobytes(), 2)
        assert back.itemsize == size and (back == x).all() and list(ids) == [7, 9]


def test_partitions_grow_slower_than_chunks():
    """A range sort samples for every partition, and the driver holds the samples."""
    assert topk._partitions(51_282, topk.CHUNK, 64) == 26
    assert topk._partitions(500_000, topk.CHUNK, 64) == topk.SPREAD
    assert topk._partitions(20_000_000, topk.CHUNK, 64) < 200


def test_usable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = df.filter(topk.usable(F.col("embedding"))).select(
        "vec_id", topk.quantised(F.col("embedding")).alias("v")).collect()
    assert [(r.vec_id, r.v) for r in got] == [(0, [32, -1]), (5, [])]


# --- Jaccard join ------------------------------------------------------------

def word_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, percent):
    """(number of the row, set size, smallest id) by all pairs of classes."""
    sets = [word_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first = {}
    for i, s in enumerate(sets):
        if s:
            parent[find(i)] = find(first.setdefault(s, i))
    classes = sorted(first.items(), key=lambda c: len(c[0]))
    for x, (s, i) in enumerate(classes):
        for s2, j in classes[x + 1:]:
            if 100 * len(s) < percent * len(s2):
                break
            both = len(s & s2)
            if 100 * both >= percent * (len(s) + len(s2) - both):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return sorted(((doc_id, len(sets[i]),
                    doc_id if not sets[i] else min((d for d in least[find(i)] if d is not None), default=None))
                   for i, (doc_id, _) in enumerate(rows)), key=str)


def check_join(df, rows, k, percent):
    got = sorted((tuple(r) for r in jaccard_join.jaccard_components(df, k, percent).collect()), key=str)
    assert got == brute_components(rows, k, percent)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_join_documents(spark, k, percent):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    check_join(df, [(r.doc_id, r.text) for r in df.collect()], k, percent)


def test_join_odd_rows(odd_documents, no_documents):
    check_join(odd_documents, [(r.doc_id, r.text) for r in odd_documents.collect()], 3, 90)
    assert jaccard_join.jaccard_components(no_documents).count() == 0
    assert jaccard_join.one_per_group(odd_documents).columns == odd_documents.columns


def near_copies(rng, count):
    """Groups of near copies, a passage that a third of all share, and chains
    whose ends are not similar."""
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    chain = [rng.choice(vocabulary) for _ in range(200)]
    rows = []
    for i in range(count):
        if i % 3 == 0:
            words = list(base)
            for _ in range(rng.randint(0, 12)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif i % 3 == 1:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 120))]
            at = rng.randint(0, len(words))
            words[at:at] = passage
        else:
            chain[i % 200] = rng.choice(vocabulary)
            words = list(chain)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("unit,heavy", [(4096, 500), (16, 500), (16, 12)])
def test_join_near_copies(spark, monkeypatch, unit, heavy):
    monkeypatch.setattr(jaccard_join, "UNIT", unit)
    monkeypatch.setattr(jaccard_join, "HEAVY_SHARE", heavy)
    monkeypatch.setattr(jaccard_join, "HEAVY_LEAST", 4)
    rows = near_copies(random.Random(unit + heavy), 360)
    check_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows, 3, 80)


def test_tree_finds_all_pairs_that_share_a_token():
    rng = np.random.default_rng(5)
    tokens = rng.integers(-2 ** 62, 2 ** 62, 60)
    sets = [np.unique(rng.choice(tokens, rng.integers(1, 8))) for _ in range(150)]
    component = rng.integers(0, 100, 150)
    flat = np.concatenate(sets)
    node = np.repeat(np.arange(150), [len(s) for s in sets])
    size = np.array([len(s) for s in sets])
    sketch = [signature_tree.parity_sketch(s.view(np.uint64), 256) for s in sets]
    a, b = signature_tree.candidates(flat, node, size[node], component[node], np.zeros(len(flat), np.int64),
                                     [sketch[i] for i in node], 60, False)
    found = set(zip(a.tolist(), b.tolist()))
    for i in range(150):
        for j in range(i + 1, 150):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 60 * (size[i] + size[j] - both) and component[i] != component[j]:
                assert (i, j) in found


def test_largest_possible_overlap_is_a_bound_and_prunes():
    """Groups of near sets that all share one token: the bound never claims more
    unshared tokens than there are, and drops almost all node pairs of different groups."""
    rng = np.random.default_rng(9)
    sets = []
    for _ in range(64):
        base = rng.integers(0, 2 ** 63, 250).astype(np.uint64)
        for _ in range(8):
            sets.append(np.unique(np.concatenate([[np.uint64(1)], base[rng.random(250) < 0.97]])))
    wide = [512, 1024, 4096]
    whole = signature_tree.Parities([signature_tree.parity_sketch(s, wide[i % 3])
                                     for i, s in enumerate(sets)]).bitmaps()
    size = np.array([len(s) for s in sets])
    same = np.ones((len(sets), signature_tree.WORDS), np.uint64)
    levels = signature_tree.build(same, whole, size, np.arange(len(sets)), np.zeros(len(sets), np.int64))
    i, j = rng.integers(0, len(sets), (2, 2000))
    apart = np.array([size[x] + size[y] - 2 * len(np.intersect1d(sets[x], sets[y])) for x, y in zip(i, j)])
    assert (signature_tree.unshared(levels[0], i, j) <= apart).all()
    for up in levels[1:]:           # any two sets below two nodes differ at least as much
        f = len(sets) // len(up.low)
        assert (signature_tree.unshared(up, i // f, j // f) <= apart).all()
    a, b = np.triu_indices(64, 1)   # inner nodes: one for each group
    assert len(signature_tree._possible(levels[1], a, b, 90, False)) < 0.1 * len(a)
    own = np.arange(64)
    assert len(signature_tree._possible(levels[1], own, own, 90, False)) == 64
    left = sum(len(x) for x, _ in signature_tree.pairs(levels, 90, False))
    assert 64 * 28 * 0.5 < left < 64 * 28 * 1.5     # of 130,816 pairs


def test_null_ids_make_no_cross_product(spark):
    rows = [(None if i % 2 else i % 7, f"text number {i} of the lot") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = docs.select(F.monotonically_increasing_id().alias("node"), "doc_id",
                        jaccard_join._mark(F.col("text")).alias("mark"))
    assert jaccard_join._texts_met(docs, nodes).count() == 400
    got = jaccard_join.node_texts(docs, nodes).collect()
    assert sorted(r.text for r in got) == sorted(t for _, t in rows)


def test_shingle_sets_match_words(document_rows):
    for r in document_rows[:60]:
        for k in (1, 3, 5):
            assert len(shingles.shingle_set(r.text, k)) == len(word_set(r.text, k))
    assert len(shingles.shingle_set(None, 3)) == 0 == len(shingles.shingle_set(" \n", 3))
    assert not np.intersect1d(shingles.shingle_set("a b", 3), shingles.shingle_set("a b c", 2)).size


def test_components_of_a_long_path(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(links.unionByName(spark.createDataFrame([(900, 901)], "a long, b long")))
    assert {(r.node, r.component) for r in got.collect()} == (
        {(i, 0) for i in range(301)} | {(900, 900), (901, 900)})
    assert components.components(links.limit(0)).count() == 0


# --- pipeline ------------------------------------------------------------------

def test_pipeline_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept, frames = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, SF01).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        frames.append(kept)
        if name != "encoding":
            assert kept.columns == docs.columns
    clean, distinct, apart, mixed, coded = [f.collect() for f in frames]

    model = toxicity.fit(docs, spark.read.parquet(f"{SF01}/labels.parquet"), F.lit(True))
    scorer = toxicity.Scorer(model)
    assert {r.doc_id for r in clean} == {i for i, r in rows.items() if scorer.score(r.text or "") < 0.7}

    groups = defaultdict(list)
    for r in clean:
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)].append(r.doc_id)
    assert sorted(r.doc_id for r in distinct) == sorted(max(g) for g in groups.values())

    found = brute_components([(r.doc_id, r.text) for r in distinct], 5, 80)
    assert sorted(r.doc_id for r in apart) == sorted(i for i, _, c in found if i == c)

    reads = defaultdict(int)
    for r in mixing.mix(frames[2]).collect():
        reads[r.doc_id] = sum(w > 0 and 2 * w >= r.size for w in (r.first_words, r.second_words))
    got = defaultdict(int)
    for r in mixed:
        got[r.doc_id] += 1
        assert r.text == rows[r.doc_id].text
    assert {i: n for i, n in reads.items() if n} == dict(got)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert len(coded) == len(mixed)
    for r in coded:
        ids = library.encode(rows[r.doc_id].text, add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline_stages_on_odd_rows(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        kept = docs.withColumn("text", F.substring("text", 1, 300))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, kept, SF01)
            if name != "encoding":
                assert out.columns == docs.columns
                kept = out
            out.count()


# --- one row of each group, told apart by row and not by id -------------------

def kept_of_components(rows, k, percent):
    """(doc_id, text) rows that stay: of each component the first by id (null
    last), set key and digest of the text; every row without words."""
    sets = [word_set(t, k) for _, t in rows]
    label = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            y, both = sets[j], len(x & sets[j])
            if x and y and label[i] != label[j] and 100 * both >= percent * (len(x) + len(y) - both):
                label = [label[j] if c == label[i] else c for c in label]

    def first(row):
        return (row[0] is None, row[0] or 0, jaccard_join._set_key(shingles.shingle_set(row[1], k)),
                hashlib.md5(row[1].encode()).digest())

    stay = [r for r, s in zip(rows, sets) if not s]
    for c in set(label):
        members = [r for r, s, own in zip(rows, sets, label) if s and own == c]
        stay += [min(members, key=first)] if members else []
    return sorted(stay, key=str)


def near_rows():
    """Near copies with null and repeated ids among unrelated texts."""
    rng = random.Random(11)

    def text(seed, changed=0):
        words = [f"{seed}{i}" for i in range(100)]
        for _ in range(changed):
            words[rng.randrange(100)] = f"new{rng.randrange(10 ** 6)}"
        return " ".join(words)

    return [(1, text("a")), (None, text("a", 1)), (None, text("b")), (None, text("c")), (None, ""), (None, None),
            (4, text("d")), (5, text("d", 1)), (5, text("e")), (5, ""),             # (5, e) is unrelated
            (3, text("a", 1)), (3, text("f")), (9, text("f", 1)),                   # {3, 9} keeps (3, f)
            (None, text("g")), (None, text("g", 1)), (None, text("g").upper()),     # no id at all
            (7, text("h")), (7, text("h", 1)), (7, text("i")), (7, text("i")), (7, text("i").replace(" ", "  "))]


def test_one_per_group_keeps_unrelated_rows_of_an_id(spark):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in jaccard_join.one_per_group(df).collect()), key=str)
    assert got == kept_of_components(rows, 5, 80)
    assert {(None, rows[2][1]), (None, rows[3][1]), (None, ""), (5, rows[8][1]), (3, rows[11][1])} <= set(got)


def test_one_per_group_same_row_of_repeats(spark):
    rows = [(1, "one two three four five six", s, n) for s, n in (("b", 1), ("c", 2), ("a", 3))] + [(2, "", "c", 4)]
    schema = "doc_id long, text string, source string, n int"
    for order in (rows, rows[::-1]):
        got = jaccard_join.one_per_group(spark.createDataFrame(order, schema).repartition(3)).collect()
        assert sorted(tuple(r) for r in got) == [rows[2], rows[3]]


def test_top_k_repeated_rows(spark, tmp_path):
    """Every row is a candidate and a query, also one that repeats id or vector or
    both, as in the SQL."""
    rng = random.Random(3)
    rows = [(i % 45, tuple(rng.randint(-4, 4) for _ in range(5))) for i in range(120)]
    rows = sorted(rows + rows[::3] + rows[:40:20])
    want = brute_top_k(rows, 7)
    df = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, v array<long>").repartition(4)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 7).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    df.select("vec_id", F.transform("v", lambda x: (x / 4).cast("float")).alias("embedding")).coalesce(1).write.parquet(
        str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert not compare(spark, "op2", queries.op2_top_k, oracle.TOP_K, str(tmp_path), con)


def test_pipeline_keeps_whole_odd_rows(spark, odd_documents, tmp_path):
    """Every stage on whole texts with null ids, repeated rows and near copies:
    the (doc_id, text) rows it keeps, by brute force."""
    blank = odd_documents.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in odd_documents.dtypes])
    more = spark.createDataFrame([(i, t, "s" if n % 2 else "u") for n, (i, t) in enumerate(near_rows())],
                                 "doc_id long, text string, source string")
    docs = odd_documents.unionByName(more.crossJoin(blank.drop("doc_id", "text", "source")).select(
        *odd_documents.columns))
    docs.write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    kept, found = docs, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, SF01).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        found.append(kept.collect())
    pairs = [sorted(((r.doc_id, r.text) for r in rows), key=str) for rows in [docs.collect(), *found[:4]]]

    scorer = toxicity.Scorer(toxicity.fit(docs, spark.read.parquet(f"{SF01}/labels.parquet"), F.lit(True)))
    assert pairs[1] == [r for r in pairs[0] if scorer.score(r[1] or "") < 0.7]

    groups = defaultdict(list)
    for i, t in pairs[1]:
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")].append((i, t))
    assert len(pairs[2]) == len(groups) and set(pairs[2]) <= set(pairs[1])
    for i, t in pairs[2]:
        own = groups.pop("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        assert i == max((d for d, _ in own if d is not None), default=None)

    assert pairs[3] == kept_of_components(pairs[2], 5, 80)

    sql = duck(SF01)
    sql.execute("CREATE OR REPLACE TEMP TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    sql.executemany("INSERT INTO temp.documents VALUES (?, ?, ?)",
                    [(r.doc_id, r.text, r.source) for r in found[2]])
    rel = sql.sql(oracle.MIXING)
    reads, got = defaultdict(int), defaultdict(int)
    for r in (dict(zip(rel.columns, x)) for x in rel.fetchall()):
        once = min(r["size"], r["taken"])
        reads[r["doc_id"], r["size"]] += sum(w > 0 and 2 * w >= r["size"] for w in (once, r["taken"] - once))
    for i, t in pairs[4]:
        got[i, len((t or "").encode().split())] += 1
    assert set(pairs[4]) <= set(pairs[3]) and dict(got) == {k: n for k, n in reads.items() if n}

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in pairs[4]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), ids, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(want) == sorted((str(r.doc_id), np.frombuffer(bytes(r.ids), "<u4").tolist(), r.decoded_sha256)
                                  for r in found[4])
