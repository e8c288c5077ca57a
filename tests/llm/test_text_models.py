"""Language-model scores, quality, personal data: brute force and held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from cellfold.llm import lm, pii, quality
from tests.llm.conftest import SF


def sf_docs():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


def held(i, folds, k):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == k


def test_lm_counts_and_base_scores(spark, make_docs):
    rows = sf_docs()[:120] + [(1000, None), (1001, ""), (1002, "THE the The"), (None, "no id here"), (3, "repeated row")]
    got = {(r.doc_id, r.n_tokens): r for r in lm.lm_scores(make_docs(rows), block_words=500, shard_chars=3000).collect()}
    toks = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    c = Counter(w for i, ws in toks if not held(i, 7, 2) for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in toks:
        r = got[i, len(ws)]
        assert r.held_out == held(i, 7, 2) and r.train_tokens == n
        assert r.n_known == sum(c[w] > 0 for w in ws)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0
    ho = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in ho) > sum(r.base_score for r in ho)  # a better model of unseen text
    assert lm.lm_scores(make_docs([])).count() == 0


def test_lm_score_is_the_interpolated_probability(spark, make_docs, monkeypatch):
    kept = {}
    real = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: kept.setdefault("w", real(*a)))
    rows = sf_docs()[:60]
    got = {r.doc_id: r.score for r in lm.lm_scores(make_docs(rows), block_words=700, shard_chars=2000).collect()}
    w = kept["w"]
    assert np.allclose(w.sum(axis=1), 1) and (w >= 0).all()
    toks = [(i, [None] + (t or "").encode().lower().split() + [None]) for i, t in rows]
    train = [ws for i, ws in toks if not held(i, 7, 2)]
    uni = Counter(x for ws in train for x in ws[1:])
    bi = Counter(p for ws in train for p in zip(ws, ws[1:]))
    n, v = sum(uni.values()), len(uni)
    for i, ws in toks:
        total = 0.0
        for h, x in zip(ws, ws[1:]):
            b = uni[h].bit_length()
            total += math.log10(w[b][2] * (bi[h, x] / uni[h] if uni[h] else 0) + w[b][1] * uni[x] / n + w[b][0] / (v + 1))
        assert math.isclose(got[i], total, rel_tol=1e-9)


def test_lm_with_nothing_to_learn_from(spark, make_docs):
    ids = [i for i in range(100) if held(i, 7, 2)][:3]
    for r in lm.lm_scores(make_docs([(i, "a b") for i in ids])).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_em_raises_the_likelihood_and_finds_the_mixture(spark):
    rng = np.random.default_rng(0)
    p = rng.random((4000, 3)) * [0.01, 0.1, 1.0]
    bucket = np.full(4000, 3, dtype=np.uint8)
    from cellfold.llm.blobs import pack
    held_rows = spark.createDataFrame([(bytearray(bucket.tobytes()), bytearray(p.astype(np.float32).tobytes()),
                                        bytearray(pack(np.ones(4000, dtype=np.int64))))],
                                      "bucket binary, p binary, n binary")
    w = lm.learn_weights(held_rows, 30)
    like = lambda x: np.log(p @ x).mean()
    grid = max(like(np.array([1 - a - b, a, b])) for a in np.linspace(0, .99, 34) for b in np.linspace(0, .99 - a, 20))
    assert like(w[3]) >= grid - 1e-3


def test_quality_learns_and_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit_quality(docs, labels)
    got = quality.quality_scores(docs, model).join(labels, "doc_id").filter("held_out").toPandas()
    good = got[got.quality == 1]
    assert (got.predicted == got.quality).mean() > 0.93
    assert (good.predicted == 1).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_quality_edge_rows(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (4, None, 0), (None, 1, 0), (5, 1, 0), (5, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "fine words"), (2, "$$$ !!"), (3, None), (3, ""), (None, "x"), (6, "Er " * 50_000)])
    model = quality.fit_quality(docs, labels)
    got = quality.quality_scores(docs, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert [r.held_out for r in got] == [held(r.doc_id, 4, 2) for r in got]
    empty = quality.fit_quality(docs, labels.limit(0))
    assert quality.quality_scores(docs.limit(0), empty).count() == 0
    assert quality.quality_scores(docs, empty).count() == 6


def test_quality_sample_is_of_rows_that_are_there(spark, make_docs):
    free = [i for i in range(200) if held(i, 4, 2) is False][:40]
    docs = [(i, f"fine plain words {i}" if i % 2 else f"$$ ## {i} !!") for i in free]
    docs += [(free[0], f"other text {k} of one id") for k in range(50)]
    rows = [(i, i % 2) for i in free] + [(i, i % 2) for i in range(1000, 3000)]  # the latter not in docs
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    seen = []

    class Seen(quality.NBSVM):
        def __init__(self, rows, labels):
            seen.append((len(rows), sum(labels)))
            super().__init__(rows, labels)

    real, quality.NBSVM = quality.NBSVM, Seen
    try:
        quality.fit_quality(make_docs(docs), labels, sample=len(free))
    finally:
        quality.NBSVM = real
    assert seen == [(len(free), sum(i % 2 for i in free))]


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(x) if i % 2 == 0 else sum(map(int, str(2 * int(x)))) for i, x in enumerate(d[::-1])) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_rules_match_the_patterns():
    rng = np.random.default_rng(4)
    alphabet = list("ab1209.@+-() é\n") + ["1.2.3.4", "4111 1111 1111 1111", "+1 (706) 555-3138", "x@y.zz", "@@", "..", "0000000255.1.1.1"]
    for _ in range(3000):
        t = "".join(rng.choice(alphabet, int(rng.integers(0, 30))))
        assert pii.rule_spans(t) == plain_spans(t), t
    for i, t in sf_docs():
        assert pii.rule_spans(t or "") == plain_spans(t or "")
    assert pii.rule_spans("1" * 100_000 + "a" * 100_000) == []


def test_model_gradient_is_exact():
    m, rng = pii.BiLstmCrf(4, 3), np.random.default_rng(0)
    chars, tags = rng.integers(0, 10, (2, 7)), np.zeros((2, 7), int)
    tags[0, 2:5] = [1, 2, 2]
    _, grad = m.loss_and_grad(chars, tags)
    for k, g in grad.items():
        at = {"trans": (1, 2), "emb": (int(chars[0, 2]), 1)}.get(k, tuple(int(rng.integers(s)) for s in g.shape))
        old = m.p[k][at]
        m.p[k][at] = old + 1e-5
        up = m.loss_and_grad(chars, tags)[0]
        m.p[k][at] = old - 1e-5
        down = m.loss_and_grad(chars, tags)[0]
        m.p[k][at] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_personal_data_with_model(spark, make_docs):
    words = [w for _, t in sf_docs()[:20] for w in t.split() if w.isalpha()]
    model = pii.train(pii.made_examples(words, 300), epochs=6)
    unseen = pii.made_examples(words, 120, seed=99)
    want = [set(s) for _, s in unseen]
    found = [set(a) for _, a in pii.find_spans(model, [t for t, _ in unseen])]
    hit = sum(len(a & b) for a, b in zip(want, found))
    assert hit / sum(map(len, want)) > 0.85 and hit / max(1, sum(map(len, found))) > 0.85
    far = "word " * 4000 + "mail me@host.org now " + "1 " * 3000
    rows = [(1, far), (2, None), (3, ""), (None, "+1 706 555 3138"), (1, far)]
    got = pii.personal_data(make_docs(rows), model).collect()
    assert len(got) == 5
    for r in got:
        base = [tuple(s) for s in r.base]
        assert set(base) <= {tuple(s) for s in r.all_spans}
    assert {(r.doc_id, len(r.base)) for r in got} >= {(None, 1), (2, 0), (3, 0)}
    assert pii.personal_data(make_docs([]), None).count() == 0
    assert pii.redact("a x@y.zz b", [("email", 2, 8)]) == "a [email] b"


def test_a_model_span_is_not_cut_inside_a_long_address():
    class Everything:
        def decode(self, chars):
            return np.full(chars.shape, 2 * pii.KINDS.index("email") + 2)

    user, host = "a.very.long.department.name." * 8 + "person", "long-host-name." * 9 + "org"
    for at in ("@", " @ "):
        text = f"write to {user}{at}{host} or so, " + "x" * 200
        (kind, a, b), = pii.model_spans(Everything(), [text])[0]
        assert kind == "email" and user + at + host in text[a:b] and len(text[a:b]) < len(text) - 100
    for text in ("q" * 300 + "7" + "q" * 300 + "7" + "q" * 90, "7" + "ab" * 99 + " " + "ab" * 99 + "7"):
        found = pii.regions(text)
        assert all(a < b for a, b in found) and all(x[1] < y[0] for x, y in zip(found, found[1:]))
