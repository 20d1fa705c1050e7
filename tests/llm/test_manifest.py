"""Merkle manifest: the whole manifest by brute force, odd rows, tampering, SQL."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import document_rows, documents, no_documents, odd_documents, sf  # noqa: F401
from tillroll.llm import merkle
from tillroll.llm.ordering import numbered


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests):
    """(last digest, for each leaf its (left, right) siblings by level)."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 8 * 8
            path.append(("".join(digests[run:at[i]]), "".join(digests[at[i] + 1:run + 8])))
            at[i] //= 8
        digests = [sha("".join(digests[i:i + 8])) for i in range(0, len(digests), 8)]
    return digests[0], paths


def brute(rows):
    def digest(r, text):
        values = (r.doc_id, r.source, r.lang, r.n_chars, text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = {}
    for r in rows:
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        low = r.text and "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        groups.setdefault(r.lang, []).append(
            (r.doc_id is not None, r.doc_id or 0, digest(r, r.text), digest(r, low if hit else r.text), r.doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    root, tops = tree([trees[g][0] for g in order])
    out = []
    for g, top in zip(order, tops):
        for leaf, path in zip(sorted(groups[g]), trees[g][1]):
            node = leaf[3]
            for left, right in path + top:
                node = sha(left + node + right)
            out.append((leaf[4], leaf[2], trees[g][0], root,
                        sha("".join(a + b for a, b in path + top)), node, node == root))
    return sorted(out, key=str)


def check(docs, rows):
    got = [tuple(r) for r in merkle.verify_documents(docs).collect()]
    assert sorted(got, key=str) == brute(rows)
    return got


def test_manifest_brute_force(documents, document_rows):
    got = check(documents, document_rows)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_odd_rows(odd_documents, no_documents):
    check(odd_documents, odd_documents.collect())
    assert merkle.verify_documents(no_documents).count() == 0
    assert merkle.verify_documents(no_documents).columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
@pytest.mark.parametrize("langs", [1, 3, 9, 70])
def test_manifest_sizes(spark, documents, n, langs):
    if langs > 3 and n in (2, 64, 513):
        pytest.skip("covered by the other sizes")
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"),
        F.concat(F.lit("l"), F.pmod(F.col("id") * 7 % 11, F.lit(langs))).alias("lang"),
        F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    if langs > 11:
        docs = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % langs))
    check(docs, docs.collect())


def test_manifest_hot_language_and_equal_rows(spark):
    """A third of the rows equal, with a null id; one language holds most rows."""
    docs = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("Same").alias("text"),
        F.when(F.col("id") % 50 > 0, "en").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.lit(4).cast("long").alias("n_chars"))
    check(docs, docs.collect())


def test_every_node_is_copied_by_weight(spark, documents):
    """No copy of a node meets more than about ``ROWS_PER_COPY`` leaf runs."""
    manifest = merkle.build_manifest(merkle.document_leaves(documents), "lang",
                                     ["doc_id", "digest", "row_tag"], ["doc_id"])
    nodes = manifest.nodes.collect()
    runs = manifest.runs.count()
    roots = [r for r in nodes if r.up_tree is None]
    assert sum(r.weight for r in roots) == runs
    assert all(r.weight <= runs for r in nodes)


def test_numbers_across_partitions(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.lit("b")).alias("g"),
        F.hash("id").alias("o"), "id")
    got = numbered(rows, ["g"], ["o", "id"], "t", number_groups=True).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append((r.o, r.id, r.pos, r.group_rows, r.group_no))
    assert len(got) == 5000
    order = sorted(groups, key=lambda g: (g is not None, g or ""))
    for g, members in groups.items():
        members.sort()
        assert [m[2] for m in members] == list(range(len(members)))
        assert {m[3:] for m in members} == {(len(members), order.index(g))}
