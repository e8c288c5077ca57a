"""Decontamination, mixing, token counts, chat, token files, the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellfold.llm import chat, decontam, mixing, pfor, queries, token_files, tokencount
from tests.llm.conftest import SF

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_hits(text, items):
    w = WORDS.findall((text or "").translate(LOWER))
    hit, own = set(), set()
    for item, t in items:
        x = WORDS.findall((t or "").translate(LOWER))
        for k in range(max(1, len(x) - 9) if x else 0):
            win = x[k:k + 10]
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    own.add("" if item is None else str(item))
    return len(w), len(hit), sorted(own)


@pytest.mark.parametrize("block_chars", [8 << 20, 60])
def test_contamination_matches_plain_search(spark, make_docs, block_chars):
    rng = random.Random(2)
    vocab = ["a", "b", "Cé", "d1", "ee"]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([14, 30, 10, 9, 3, 2, 12])]
    items += [(7, items[0][1]), (7, items[0][1]), (8, None), (9, " .,! "), (None, "zz yy xx")]
    docs = [(i, line(rng.randint(0, 60))) for i in range(30)]
    docs += [(30 + i, line(5) + "; " + t.upper().replace("É", "é") + " " + line(4)) for i, (_, t) in enumerate(items[:7])]
    docs += [(50, None), (51, ""), (None, "q zz, yy-xx q"), (3, docs[3][1]), (52, items[0][1] * 3)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in
           decontam.contamination(make_docs(docs), bench, block_chars=block_chars).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted([(i, *plain_hits(t, items)) for i, t in docs], key=key)
    clean = decontam.clean_documents(make_docs(docs), bench, block_chars=block_chars)
    assert sorted((r.doc_id or 0, r.text or "") for r in clean.collect()) == sorted(
        (i or 0, t or "") for i, t in docs if plain_hits(t, items)[1] == 0)
    assert "component_id" in clean.columns


def test_item_blocks_hold_a_repeated_item_once(spark):
    rows = [("a", "same words " * 10)] * 400 + [(str(k), f"item {k} " * 10) for k in range(40)]
    items = spark.createDataFrame(rows, "item_id string, text string")
    blocks = [b.collect() for b in decontam.item_blocks(items, "item_id", "text", 2000)]
    assert sorted(map(tuple, (r for b in blocks for r in b))) == sorted(set(rows))
    assert max(sum(len(r.text) + 16 for r in b) for b in blocks) < 6000


def test_contamination_of_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.contamination(make_docs([]), bench).count() == 0
    r = decontam.contamination(make_docs([(1, "a b c")]), bench.limit(0)).first()
    assert (r.n_words, r.n_hit, r.item_ids, r.spans) == (3, 0, [], [])
    assert decontam.contamination(make_docs([(1, "x a b c y")]), bench).first().spans == [[1, 4]]


def test_mix_counts_are_the_inverse_of_the_distribution(spark, make_docs):
    rows = [(i, "x" * (i % 50), ("big" if i % 3 else "small") if i % 7 else None) for i in range(600)]
    docs = make_docs(rows).drop("u")
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0), ("absent", 1.0), (None, 0.5)], "source string, weight double")
    out = mixing.poisson_mix(docs, weights, seed=4).collect()
    size = Counter()
    for i, t, s in rows:
        size[s] += len(t) + 1
    w = {"big": 1.0, "small": 3.0, None: 0.5}
    n = Counter(r.doc_id for r in out)
    import hashlib
    for i, t, s in rows:
        rate = w[s] / sum(w.values()) * sum(size.values()) / size[s]
        u = (int(hashlib.md5(f"4:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        k, p = 0, math.exp(-rate)
        total = p
        while total < u:
            k += 1
            p *= rate / k
            total += p
        assert n[i] == k
    assert [r.mix_key for r in out] == sorted(r.mix_key for r in out)
    mass = Counter()
    for r in out:
        mass[r.source] += len(r.text) + 1
    for s in w:
        assert abs(mass[s] / sum(mass.values()) - w[s] / sum(w.values())) < 0.08


def test_mix_edge_rows(spark, make_docs):
    docs = make_docs([(1, None, None), (1, None, None), (None, "abc", "a"), (2, "", "a")])
    out = mixing.poisson_mix(docs, budget=40.0, seed=2).collect()
    assert len(out) % 1 == 0 and {r.doc_id for r in out} <= {1, 2, None}
    assert Counter(r.doc_id for r in out)[1] % 2 == 0  # repeated rows draw alike
    assert mixing.poisson_mix(docs.limit(0)).count() == 0
    none = spark.createDataFrame([], "source string, weight double")
    assert mixing.poisson_mix(docs, none).count() == 0
    salted = mixing.BROADCAST_SOURCES
    try:
        mixing.BROADCAST_SOURCES = 0
        again = mixing.poisson_mix(docs, budget=40.0, seed=2).collect()
    finally:
        mixing.BROADCAST_SOURCES = salted
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_large_means_are_drawn_in_parts(spark, make_docs):
    docs = make_docs([(i, "", "tiny") for i in range(30)] + [(99, "y" * 9, "big")])
    out = mixing.poisson_mix(docs.drop("u"), budget=60_000.0, seed=3)  # mean 1000 and 3000
    n = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert all(abs(n[i] - 1000) < 6 * math.sqrt(1000) for i in range(30))
    assert abs(n[99] - 3000) < 6 * math.sqrt(3000)
    assert abs(sum(n[i] for i in range(30)) - 30_000) < 6 * math.sqrt(30_000)
    assert out.select("doc_id", "mix_part", "mix_copy").distinct().count() == sum(n.values())
    assert out.agg({"mix_part": "max"}).first()[0] == 11
    old = mixing._LIST
    try:
        mixing._LIST = 3
        again = mixing.poisson_mix(docs.drop("u"), budget=60_000.0, seed=3)
        assert again.select("mix_key").collect() == out.select("mix_key").collect()
    finally:
        mixing._LIST = old


def test_large_rates_follow_the_distribution(spark):
    from pyspark.sql import functions as F
    cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(2000.0)).alias("c")).first()["c"]
    assert abs(cdf[2000] - 0.506) < 0.01 and abs(cdf[-1] - 1) < 1e-9 and abs(cdf[1900] - 0.0128) < 0.002


def plain_unigram(model, word):
    full = tokencount.MARK + word
    best = [(0.0, 0)]
    for i in range(1, len(full) + 1):
        size = len(full[i - 1].encode())
        options = [(best[i - 1][0] + model.byte * size, -(best[i - 1][1] + size))]
        options += [(best[j][0] + model.log_prob[full[j:i]], -(best[j][1] + 1))
                    for j in range(i) if full[j:i] in model.log_prob]
        s, n = max(options)
        best.append((s, -n))
    return best[-1][1]


def test_token_counts_match_separate_passes(spark, make_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = tokencount.Unigram.from_sentencepiece(path)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    rows += [(900, None), (901, ""), (902, " \n "), (None, "你好 \x01 a"), (903, "z" * 5000 + " the the"), (0, "again")]
    got = tokencount.token_counts(make_docs(rows), path, memory=50, batch_chars=3000).collect()
    want = [(i, len((t or "").split()), len(set((t or "").split())),
             sum(plain_unigram(model, w) for w in (t or "").split())) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert tokencount.token_counts(make_docs([]), path).count() == 0


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\[INST] b </s>\\"), (2, 0, "assistant", None), (2, 1, None, "x"),
         (2, 1, None, "x"), (2, 2, "to[=]ol</s>", "<s>[/ROLE]"), (3, 0, "system", ""), (3, 1, "user", " lead "),
         (3, 2, "assistant", "<</s>>"), (None, 5, "user", "no id"), (4, None, "user", "[ROLE:x[=]"), (4, 1, "user", "<s")]


def test_chat_reads_back(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as formatted")
    f = chat.Format()
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    for conv in {c[0] for c in CHATS}:
        turns = sorted(((t, r or "", x or "") for c, t, r, x in CHATS if c == conv), key=lambda t: (t[0] is not None, t))
        r = out[conv]
        assert f.read(r.formatted) == [t[1:] for t in turns]
        assert r.formatted == "".join(s.text for s in r.segments)
        assert [f.unescape(r.formatted[s.start:s.end]) for s in r.loss_spans] == [t[2] for t in turns if t[1] == "assistant"]
    assert out[1].fault is None and out[3].fault is None
    assert "after" in out[2].fault and out[None].fault == "ends with user"
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_escape_round_trip():
    f, rng = chat.Format(), random.Random(0)
    parts = ["\\", "<s>", "</s>", "[INST]", "[/INST]", "[", "]", "<", "/s>", "INST]", " ", "x", "[=]", "[ROLE:", "\n"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "".join(rng.choices(parts, k=2)).strip() or "q"]),
                  "".join(rng.choices(parts, k=rng.randint(0, 8)))) for _ in range(rng.randint(1, 4))]
        text = "".join(s for s, _ in f.segments(turns))
        assert f.read(text) == turns


def test_pfor_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 999, 1000, 10_000):
        ids = np.where(rng.random(n) < .03, rng.integers(0, 2 ** 32, n), rng.integers(100, 5000, n)).astype(np.uint32)
        f = pfor.File(pfor.encode_file([7, None], np.array([n // 2, n - n // 2]), ids, block=1000))
        assert (f.ids() == ids).all() and f.doc_ids == [7, None] and f.lengths.sum() == n
        assert (f.ids(n // 3, n // 2) == ids[n // 3:n // 2]).all()
    same = np.full(5000, 9, dtype=np.uint32)
    data = pfor.encode_file([1], np.array([5000]), same)
    assert len(data) < 100 and (pfor.File(data).ids() == same).all()


def test_word_encoder_equals_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    enc, tok = token_files.WordEncoder(path, memory=20), Tokenizer.from_file(path)
    texts = [None, "", "  ", "it's I'LL ÀÉÎß µm ªº ×÷ x² <|endoftext|> a<|startoftext|>b İstanbul ΣΑΣ é don't''s 's't"
             " \x85 x\x1c 你好 😀 l'été 12a3 __x__ \x7f \xad\xa0 ÿ", "a" * 3000 + " b", "'re're've 'LL'"]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == [
        tok.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_files_hold_all_documents_in_order(spark, make_docs, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(None, "null id"), (5, None), (7, ""), (7, "")]
    random.Random(1).shuffle(rows)
    out = str(tmp_path / "files")
    token_files.write_token_files(make_docs(rows), out, path, file_ids=5000, range_chars=60_000)
    assert spark.read.parquet(out).count() > 20
    got = sorted(token_files.digests(token_files.read_token_files(spark, out)).collect(), key=lambda r: r.start)
    tok, at = Tokenizer.from_file(path), 0
    want = Counter()
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    empty = str(tmp_path / "empty")
    token_files.write_token_files(make_docs([]), empty, path)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_llm_oracles(spark):
    from tests.oracle_check import compare, duck
    con = duck(SF)
    for key, sql in queries.ORACLE_SQL.items():
        r = compare(spark, key, queries.QUERIES[key], sql, SF, con)
        assert r["values_match"], r


def test_native_operator_runs_no_python(spark):
    plan = queries.op6_mix_sources(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
