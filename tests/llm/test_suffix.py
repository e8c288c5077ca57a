"""Repeated byte strings against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellfold.llm import suffix
from tests.llm.conftest import SF


def plain_spans(texts, length):
    """Spans of bytes covered by a string of ``length`` bytes that starts at two places."""
    raw = [(t or "").encode() for t in texts]
    starts = defaultdict(int)
    for t in raw:
        for p in range(len(t) - length + 1):
            starts[t[p:p + length]] += 1
    out = []
    for t in raw:
        hit = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - length + 1):
            if starts[t[p:p + length]] > 1:
                hit[p + 1:p + length + 1] = True
        edge = np.diff(hit.astype(np.int8))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return raw, out


def check(df, rows, length, **params):
    raw, spans = plain_spans([r[1] for r in rows], length)
    want = Counter()
    for (doc, *_), t, own in zip(rows, raw, spans):
        kept = b"".join(t[a:b] for a, b in zip([0, *[e for _, e in own]], [*[s for s, _ in own], len(t)]))
        want[doc, len(t), tuple(own), kept] += 1
    got = Counter((r.doc_id, r.n_bytes, tuple((s.start, s.stop) for s in r.spans), bytes(r.kept))
                  for r in suffix.remove_repeats(df, length=length, **params).collect())
    assert got == want


def passages(rng):
    word = lambda: "".join(rng.choices("abé ", k=rng.randint(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    common, line = text(25), text(6)
    rows = [(i, text(rng.randint(0, 40))) for i in range(40)]
    rows += [(100 + i, text(rng.randint(0, 9)) + common + text(rng.randint(0, 9))) for i in range(12)]
    rows += [(200 + i, f"{i} {line} {i}") for i in range(80)]  # one gram in many unlike segments
    rows += [(300, rows[3][1])] * 9 + [(None, common), (2 ** 53 + 1, None), (400, ""), (401, "z" * 900)]
    near = rows[45][1]
    rows += [(500 + i, near[:i * 3] + "Q" + near[i * 3 + 1:]) for i in range(10)]
    return rows


@pytest.mark.parametrize("length, params", [
    (12, {}), (20, {"bucket_rows": 8, "block_bytes": 400, "shard_bytes": 900}),
    (33, {"bucket_rows": 3, "block_bytes": 2000, "shard_bytes": 500}), (2, {"bucket_rows": 50})])
def test_repeats_match_brute_force(make_docs, length, params):
    rows = passages(random.Random(length))
    check(make_docs(rows).repartition(3), rows, length, **params)


def test_repeats_in_documents(spark, make_docs):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(make_docs(rows), rows, 200, bucket_rows=64, shard_bytes=100_000)


def test_empty_table_and_short_texts(make_docs):
    assert suffix.remove_repeats(make_docs([])).count() == 0
    rows = [(1, "a"), (1, "a"), (2, None)]
    check(make_docs(rows), rows, 200)


def test_pieces_of_a_long_text_have_the_same_anchors(monkeypatch):
    text = bytes(random.Random(1).choices(b"ab ", k=5000)) + b"z" * 1000
    whole = suffix.anchors_of(text, 40)
    monkeypatch.setattr(suffix, "_PLACE", 9)
    for a, b in zip(suffix.anchors_of(text, 40)[1:], whole[1:]):
        assert (a[0], a[-1]) == (b[0], b[-1])
    lo, hi = suffix.anchors_of(text, 40)[1:]
    assert (lo[1:] == hi[:-1] + 1).all() and lo[0] == 0 and hi[-1] == len(text) - 40


def test_multikey_sort():
    rng = np.random.default_rng(0)
    strings = rng.integers(0, 2, (500, 37)).astype(np.uint8) * rng.integers(0, 2, (500, 1)).astype(np.uint8)
    strings = np.repeat(strings, 2, axis=0)
    order, common = suffix.multikey_sort(strings)
    rows = [bytes(strings[i]) for i in order]
    assert rows == sorted(map(bytes, strings))
    for i in range(1, len(rows)):
        n = next((k for k in range(37) if rows[i][k] != rows[i - 1][k]), 37)
        assert common[i] == n
