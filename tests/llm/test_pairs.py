"""SimHash groups, components and embedding groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from cellfold.llm import embed, graph, simhash


def root_of(n, pairs):
    low = list(range(n))
    def find(i):
        while low[i] != i:
            i = low[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    table = {c: c + 32 for c in range(65, 91)}
    words, word = [], ""
    for c in (text or "").translate(table) + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_matches_plain_rule():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "one", "One two", "a b c", "É x y z", "Ab aB AB ab", "x " * 9]
    texts += [" ".join(rng.choice(["the", "Of", "été", "q", "zz"]) for _ in range(n)) for n in (4, 50, 333)]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    long = " ".join(str(i % 777) for i in range(70_000))
    assert simhash.fingerprint(long) == plain_fingerprint(long)


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_have_the_components_of_all_pairs(spark, bucket):
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:20]:
        for _ in range(6):
            w = v
            for _ in range(rng.randint(0, 4)):
                w ^= 1 << rng.randrange(64)
            values.append(w)
    values = sorted({0, 1, 3, 7, (1 << 64) - 1, *values})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {(r.a, r.b) for r in simhash.links(fps, 2, bucket=bucket).collect()}
    close = [(i, j) for i in range(len(values)) for j in range(i)
             if (values[i] ^ values[j]).bit_count() <= 2]
    at = {v: i for i, v in enumerate(signed)}
    assert root_of(len(values), close) == root_of(len(values), [(at[a], at[b]) for a, b in got])
    if bucket == 64:
        assert {frozenset(p) for p in got} == {frozenset((signed[i], signed[j])) for i, j in close}


def test_simhash_groups_edge_rows(spark, make_docs):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, None), (8, ""), (7, "other words here now"),
            (None, "a b c d"), (None, "alone in the world of ids")]
    got = [tuple(r) for r in simhash.simhash_groups(make_docs(rows)).collect()]
    assert len(got) == len(rows)
    of = {(i, f): c for i, f, c in got}
    same = f"{plain_fingerprint('a b c d'):016x}"
    assert of[5, same] == of[3, same] == of[None, same] == 3
    assert of[9, "0" * 16] == of[8, "0" * 16] == 8
    assert of[None, f"{plain_fingerprint('alone in the world of ids'):016x}"] is None
    assert simhash.simhash_groups(make_docs([])).count() == 0


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 200)]
    pairs += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(pairs)
    edges = spark.createDataFrame(pairs + pairs[:5], "a long, b long")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    want = root_of(400, pairs)
    assert got == {n: want[n] for p in pairs if p[0] != p[1] for n in p}
    assert graph.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("tile", [2048, 8])
def test_embedding_groups_match_all_pairs(spark, tile):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(12):
        base = rng.standard_normal(16)
        for k in range(8):
            v = base + rng.standard_normal(16) * (0.02, 0.12, 0.2)[k % 3]
            rows.append((len(rows), [float(np.float32(x)) for x in v], int(g % 3)))
    n = len(rows)
    rows += [(n + i, rows[0][1], 0) for i in range(12)]  # equal vectors
    rows += [(n + 12, rows[0][1], 1), (n + 13, rows[0][1], None), (n + 14, None, 0), (n + 15, [], 0),
             (n + 16, [0.0] * 16, 0), (n + 17, [None] + rows[0][1][1:], 0),
             (n + 18, [float("nan")] + rows[0][1][1:], 0), (n + 19, [float("inf")] * 16, 0),
             (n + 20, rows[0][1][:8], 0), (n + 21, [x * 1e30 for x in rows[0][1]], 0), rows[3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 as links", "2 as root")
    got = {r.vec_id: tuple(r)[1:] for r in embed.embedding_groups(df, tile=tile).collect()}

    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v)
    rows = rows[:-1]
    pairs = []
    for i, (_, a, x) in enumerate(rows):
        for j, (_, b, y) in enumerate(rows[:i]):
            if x is not None and x == y and usable(a) and usable(b) and len(a) == len(b):
                a_, b_ = np.array(a, dtype=np.float32).astype(float), np.array(b, dtype=np.float32).astype(float)
                if a_ @ b_ / np.sqrt((a_ @ a_) * (b_ @ b_)) >= 0.98:
                    pairs.append((i, j))
    root = root_of(len(rows), pairs)
    count = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    assert got == {i: (int(count[i]), root[i], root[i] == i) for i in range(len(rows))}
    assert embed.embedding_groups(df.limit(0)).count() == 0


def test_embedding_rows_that_share_an_id(spark):
    x, y, z = [1.0, 0.0, 0.1], [0.0, 1.0, 0.0], [1.0, 0.0, 0.12]
    rows = [(5, x), (5, y), (5, [2 * v for v in x]), (7, y), (3, z), (9, [0.0, 0.0, 1.0]), (None, x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as label")
    got = sorted((tuple(r) for r in embed.embedding_groups(df).collect()), key=str)
    assert got == sorted([(5, 5, 3, False)] * 3 + [(7, 1, 3, False), (3, 2, 3, True), (9, 0, 9, True),
                                                  (None, 0, None, True)], key=str)


def test_quantisation_bound_covers_the_error():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (embed.encode(list(rng.standard_normal(24) * 10.0 ** rng.integers(-5, 5))) for _ in range(2))
        approx = a[2] * b[2] * float(a[1].astype(int) @ b[1].astype(int))
        assert abs(approx - a[0] @ b[0]) <= (1 + a[3]) * b[3] + a[3] + embed.SLACK
