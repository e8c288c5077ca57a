"""Ids are 64-bit integers and come back whole, also beside null ids; hot ids; odd columns."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellfold.llm import chat, common, decontam, lm, mixing, pii, quality, simhash, token_files, tokencount
from cellfold.llm.queries import read_back

BIG = [2 ** 53 + 1, 2 ** 63 - 1, -2 ** 63, None, 2 ** 53 + 3]
TEXTS = ["one two three four five", "alpha beta gamma delta epsilon zeta", "call +1 (234) 567-8901 now",
         "rest of it all is here", "q r s t u v w x"]


@pytest.fixture
def big(make_docs):
    return make_docs(list(zip(BIG, TEXTS)))


def ids(df, col="doc_id"):
    return Counter(r[0] for r in df.select(col).collect())


def test_large_ids_beside_nulls(spark, big, tmp_path):
    bench = spark.createDataFrame([(1, "zeta zeta")], "item_id long, text string")
    two = spark.createDataFrame([(1, "w " * 40), (2, "v " * 40)], "item_id long, text string")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    labels = big.select("doc_id", F.lit(1).alias("quality"))
    out = str(tmp_path / "ids")
    token_files.write_token_files(big, out, vocabulary)
    for got in (simhash.simhash_groups(big), simhash.representatives(big), lm.lm_scores(big),
                decontam.contamination(big, bench), decontam.contamination(big, two, block_chars=60),
                pii.personal_data(big, None), mixing.poisson_mix(big).select("doc_id").distinct(),
                tokencount.token_counts(big, public_tokenizers.path("piece_bpe_32k.model")),
                quality.quality_scores(big, quality.fit_quality(big, labels)),
                token_files.read_token_files(spark, out)):
        assert set(ids(got)) <= set(BIG)
        if "mix_key" not in got.columns and got.count() == 5:
            assert ids(got) == Counter(BIG)
    assert simhash.representatives(big).count() == 5
    assert ids(simhash.simhash_groups(big), "component_id") == Counter(BIG)
    turns = spark.createDataFrame([(i, 0, "user", t) for i, t in zip(BIG, TEXTS)],
                                  "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(turns)
    assert ids(formatted, "conv_id") == ids(read_back(formatted), "conv_id") == Counter(BIG)


def test_pipeline_keeps_large_ids(spark, big, tmp_path):
    kept = corpus_pipeline.near_duplicates(spark, big, "")
    assert ids(kept) == Counter(BIG)
    assert ids(corpus_pipeline.token_output(spark, kept, "")) == Counter(BIG)


def test_representatives_with_odd_columns(spark):
    df = spark.createDataFrame(
        [(1, "a b c d", 5, {"k": 1}), (1, "a b c d", 5, {"k": 1}), (2, "a b c d", 6, {"k": 2}), (None, "z y x", 7, None)],
        "doc_id long, text string, `lead.id` long, lead_h1 map<string,long>")
    df = df.withColumn("lead_id", F.lit("x")).withColumn("n", F.lit(0)).withColumn("c1", F.lit(2))
    got = simhash.representatives(df)
    assert got.columns == df.columns
    assert sorted(((r[0], r[2], r[3]) for r in got.collect()), key=str) == [(1, 5, {"k": 1}), (None, 7, None)]


def test_copies_of_one_document_are_dealt_over_ranges(spark, make_docs, tmp_path):
    """A third of the rows has one id and a third none: both go to many ranges, in order."""
    rows = [(i, f"document {i} " + "word " * (i % 7)) for i in range(1000)]
    rows += [(500, "hot copy of one text")] * 700 + [(500, "another")] * 300 + [(None, "no id")] * 1000
    rows += [(-2 ** 63, "least")] * 3
    docs, path = make_docs(rows).repartition(6), str(tmp_path / "hot")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), range_chars=800)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    files = [token_files.File(bytes(r.data)) for r in spark.read.parquet(path).collect()]
    for hot in (500, None):
        each = [f.doc_ids.count(hot) for f in files if hot in f.doc_ids]
        assert len(each) >= 8 and max(each) <= 300


def test_range_lookup_is_flat_in_the_number_of_ranges():
    """A look-up is a binary search: its steps grow with the logarithm of the ranges."""
    cuts = np.arange(0, 10_000_000, 10)
    keys = np.array([0, 9, 10, 9_999_999, 5, -1])
    found = token_files.Ranges(cuts).of(keys, np.ones(6, bool), None, 0, Counter())
    assert found.tolist() == [1, 1, 2, 1_000_000, 1, 0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "digits"])
def test_encoder_matches_other_vocabularies(name, tmp_path):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json" if name == "digits" else name)
    if name == "digits":
        said = open(path, encoding="utf-8").read().replace(r"[\\p{N}]|", r"[\\p{N}]+|")
        path = str(tmp_path / "other.json")
        open(path, "w", encoding="utf-8").write(said)
    enc, tok = token_files.WordEncoder(path, memory=3), Tokenizer.from_file(path)
    texts = ["a  b 123 45", "", None, "x\n\ny 2024 <|endoftext|> z", " lead 12 é 你好"]
    assert enc.by_word == (name == "word_bpe_49k.json")
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    long = "Some words, 12 é ".encode() * 500
    assert enc.encode_long(long, 64).tolist() == tok.encode(long.decode(), add_special_tokens=False).ids


def test_long_text_is_encoded_in_parts(spark, make_docs, tmp_path):
    text = "ab, cd 12 " * 40_000
    docs, path = make_docs([(1, text), (2, "x")]), str(tmp_path / "long")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    cuts = token_files.id_cuts(docs, "doc_id", "text", 4 << 20)
    got = {r.doc_id: r for r in token_files.encoded(docs, vocabulary, "doc_id", "text", cuts, batch_bytes=1000).collect()}
    token_files.write_token_files(docs, path, vocabulary)
    crc = {r.doc_id: r.ids_crc32 for r in token_files.digests(token_files.read_token_files(spark, path)).collect()}
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(got[1].ids)), "<u2")
    assert zlib.crc32(raw.astype("<u4").tobytes()) == crc[1]


def test_sampled_cuts_do_not_depend_on_partitions(spark):
    """Cuts lie at equal ranks, also where the sorted sample has more partitions than cuts."""
    rows = spark.range(10_000).selectExpr("id * 7 % 10000 as k")
    for n in (1, 8, 200):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert sorted(common.sampled_cuts(rows, 10_000, 10, each=1000)) == list(range(999, 9000, 1000))
        cuts = sorted(common.sampled_cuts(rows, 10_000, 10, each=100))
        assert len(cuts) == 9 and max(abs(c - 1000 * (i + 1)) for i, c in enumerate(cuts)) < 700
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert common.sampled_cuts(rows.limit(0), 0, 1) == []
