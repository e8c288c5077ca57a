"""The manifest against a plain recursive computation."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cellfold.llm import merkle, queries
from tests.llm.conftest import DOCS, SF


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, fan):
    """(root, proofs) of (name, digest) nodes in order: a proof is the levels' siblings with the own place."""
    proofs, at = {n: [] for n, _ in nodes}, [([n], d) for n, d in nodes]
    while len(at) > 1:
        up = []
        for i in range(0, len(at), fan):
            run = at[i:i + fan]
            for k, (names, _) in enumerate(run):
                for n in names:
                    proofs[n].append(("".join(d for _, d in run[:k]), "".join(d for _, d in run[k + 1:])))
            up.append((sum((names for names, _ in run), []), h(*[d for _, d in run])))
        at = up
    return at[0][1], proofs


def plain(rows, fan=16):
    """{row number: (leaf, subroot, root, proof)}; rows of (doc_id, source, lang, n_chars, text)."""
    leaves = {i: leaf(r) for i, r in enumerate(rows)}
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[1], []).append(i)
    subs, own = {}, {}
    for s, members in groups.items():
        members.sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
        subs[s], proofs = climb([(i, leaves[i]) for i in members], fan)
        own |= proofs
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    root, tops = climb([(s, subs[s]) for s in order], fan)
    return {i: (leaves[i], subs[r[1]], root, own[i] + tops[r[1]]) for i, r in enumerate(rows)}


def table(spark, rows):
    df = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], DOCS)
    for c in ("tree", "idx", "n", "digest", "block", "proof", "part", "root"):
        df = df.withColumn(c, F.lit("x"))
    return df


ROWS = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(40)] + [
    (i, "S", None, None, "é" * i) for i in range(290)] + [
    (7, None, "x", 1, None), (None, None, None, None, None), (None, "s1", "de", 3, "null id"),
    (5, "s1", "en", 9, "same id"), (5, "s1", "en", 9, "same id"), (2 ** 63 - 1, "é", "", 0, ""), (-2 ** 63, "z", "", 0, "A B")]


@pytest.mark.parametrize("fan, height", [(16, 2), (2, 3), (16, 1)])
def test_manifest_matches_plain_trees(spark, fan, height):
    found = merkle.merkle_manifest(table(spark, ROWS).repartition(5), fan=fan, height=height)
    got = sorted((r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof)), r.doc_id is None, r.doc_id or 0) for r in
                 found.withColumn("folds", merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root"))
                 .filter("folds").collect())
    want = sorted((a, b, c, tuple(p), ROWS[i][0] is None, ROWS[i][0] or 0)
                  for i, (a, b, c, p) in plain(ROWS, fan).items())
    assert got == want


def test_small_trees(spark):
    assert merkle.merkle_manifest(table(spark, [])).count() == 0
    for rows in (ROWS[:1], ROWS[:2], ROWS[:3] + ROWS[3:4], [ROWS[-5]]):
        got = sorted((r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof)))
                     for r in merkle.merkle_manifest(table(spark, rows)).collect())
        assert got == sorted((a, b, c, tuple(p)) for a, b, c, p in plain(rows).values())


def test_query_on_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "source", "lang", "n_chars", "text").collect()]
    lower = {c: c + 32 for c in range(65, 91)}
    want = set()
    for i, (own, sub, root, proof) in plain(docs).items():
        doc, source, lang, n, text = docs[i]
        if zlib.crc32(str(doc).encode()) % 5 == 0:
            text = None if text is None else text.translate(lower)
        d = leaf((doc, source, lang, n, text))
        for a, b in proof:
            d = h(a, d, b)
        want.add((doc, own, sub, root, h(*[a + b for a, b in proof]), d, d == root))
    got = queries.op13_manifest(spark, SF).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)
    assert {r.verified for r in got} == {True, False}
