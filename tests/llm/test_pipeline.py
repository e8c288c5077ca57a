"""The pipeline against a brute-force version of its stages on a small fixture."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
from cellfold.llm import quality
from tests.llm.conftest import SF
from tests.llm.test_documents import plain_hits
from tests.llm.test_pairs import plain_fingerprint, root_of


def test_pipeline_matches_plain_stages(spark):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=lambda r: r[1])
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    model = quality.fit_quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    find = quality.Indicators()
    docs = [d for d in docs if model.score(find.of(d["text"])) >= 0.7]
    docs.sort(key=lambda d: d["doc_id"])
    fps = [plain_fingerprint(d["text"]) for d in docs]
    root = root_of(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    docs = [d for i, d in enumerate(docs) if root[i] == i]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    docs = [d for d in docs if plain_hits(d["text"], items)[1] == 0]
    size = {}
    for d in docs:
        size[d["source"]] = size.get(d["source"], 0) + len(d["text"]) + 1
    tok, rows, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for d in docs:
        rate = sum(size.values()) / len(size) / size[d["source"]]
        u = (int(hashlib.md5(f"1:{d['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        k, p = 0, math.exp(-rate)
        total = p
        while total < u:
            k, p = k + 1, p * rate / (k + 1)
            total += p
        ids = [*tok.encode(d["text"], add_special_tokens=False).ids, 1]
        for _ in range(k):
            rows.append((d["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    assert got == rows


def test_stages_keep_the_columns_and_handle_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    rows = [(1, "plain words in a row", "en", "a", 20, "x"), (1, "plain words in a row", "en", "a", 20, "x"),
            (2, None, None, None, None, None), (None, "other words of no id", "en", "b", 3, "y"), (3, "", "en", "b", 0, "z")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == corpus_pipeline.COLUMNS, name
            assert out.count() >= 0
        assert corpus_pipeline.token_output(spark, docs, SF).count() == len(data)
    once = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert sorted(r.doc_id or 0 for r in once) == [0, 1, 2]


def test_near_duplicates_keep_one_row_of_each_group_whatever_the_ids(spark, make_docs):
    def text(k):
        return " ".join(hashlib.md5(f"{k}:{i}".encode()).hexdigest() for i in range(30))
    rows = [(None, text(k)) for k in range(6)]                    # no id, all different
    rows += [(7, text("a")), (7, text("b"))]                      # one id, two texts
    rows += [(4, text("c")), (None, text("c")), (9, text("c"))]   # copies, one without id
    rows += [(None, text("d"))] * 5 + [(5, text("e"))] * 3        # repeated rows
    got = corpus_pipeline.near_duplicates(spark, make_docs(rows), SF).collect()
    kept = [(None, text(k)) for k in range(6)] + [(7, text("a")), (7, text("b")), (4, text("c")),
                                                  (None, text("d")), (5, text("e"))]
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((i or 0, t) for i, t in kept)
