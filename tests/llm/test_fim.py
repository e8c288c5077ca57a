"""Fill-in-the-middle against a plain computation over code points."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellfold.llm import fim
from tests.llm.conftest import SF


def plain(doc_id, text, unit, rate, spm):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", text, None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m), text
    return doc_id, len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m), text


@pytest.mark.parametrize("unit, rate, spm", [("line", 100, 50), ("char", 100, 50), ("char", 40, 0), ("line", 60, 100)])
def test_matches_plain_cuts(spark, make_docs, unit, rate, spm):
    rng = random.Random(unit + str(rate))
    parts = ["a", "é", "你", "😀", "\n", "\r\n", " ", "<", "P>", "S", "<M", ">", " ", "\x00", "́"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 30)))) for i in range(400)]
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(1, None), (2, ""), (None, "no\nid"), (2 ** 53 + 1, "x\ny\n"), (3, "has <M> mark\n" * 3), (4, "\n" * 9),
             (5, "é\n" * 50_000), (5, "é\n" * 50_000), (6, "one line of plain text")]
    got = Counter(map(tuple, fim.fill_in_middle(make_docs(rows), unit=unit, rate=rate, spm=spm, batch_bytes=9000)
                      .select("*", fim.restored(F.col("form"), F.col("output"))).collect()))
    assert got == Counter(plain(i, t, unit, rate, spm) for i, t in rows)


def test_empty_table_and_bad_unit(make_docs):
    assert fim.fill_in_middle(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(make_docs([]), unit="word")


def test_exception_index_is_sparse_and_exact():
    for text in ("", "plain", "é", "aé你😀b", "😀" * 40 + "x" * 1000 + "ü"):
        raw, index = text.encode(), fim.Exceptions(text.encode())
        assert len(index.at) == sum(len(c.encode()) > 1 for c in text)
        for k in range(len(text) + 1):
            at = len(text[:k].encode())
            assert index.bytes(k) == at and index.chars(at) == k
        assert index.chars(len(raw)) == len(text)
