"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item's windows are its runs of ``window`` consecutive words (an
item of fewer words is one window). A document is contaminated by the words
that lie inside any exact occurrence of a window.

A window occurs only where all its word shingles occur, so under the order by
rarity its necessary prefix is one shingle: the rarest. The join goes through
that shingle alone. Rarity is counted over all documents. A meeting at
document position p with a shingle at offset o of the window is a candidate
only if the window starts at p - o >= 0 and ends within the document
(positional bound) and is no longer than the document (length bound); the
candidates' words are then compared one by one.

The benchmark side is the stated query set. Its size is measured; it is sent
to the tasks in blocks of at most ``block_chars`` characters, and each block
meets all documents. Document texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.common import id_text, utf8, with_long_id

#: A-Z to a-z; every other ASCII byte that is not 0-9 or a-z to a blank.
_WORD_BYTES = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
    else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
    return utf8(text).translate(_WORD_BYTES).split()


def shingle_keys(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit key for each run of ``width`` word codes (0 where a word is unknown).

    Keys may collide; a collision only makes a candidate that the word
    comparison discards.
    """
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    key, known = np.full(n, width, dtype=np.uint64), np.ones(n, dtype=bool)
    for k in range(width):
        part = codes[k:k + n]
        known &= part > 0
        key = (key ^ part.astype(np.uint64)) * _M1
        key ^= (key >> np.uint64(29)) * _M2
    return np.where(known, key | np.uint64(1), np.uint64(0))


class Windows:
    """The windows of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int, shingle: int):
        self.vocab: dict[bytes, int] = {}
        owners: dict[tuple, set[str]] = {}
        for item, text in items:
            codes = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            for i in range(max(1, len(codes) - window + 1) if codes else 0):
                owners.setdefault(tuple(codes[i:i + window]), set()).add(item)
        self.window, self.shingle = window, shingle
        self.codes = [np.array(w, dtype=np.int64) for w in owners]
        self.owners = [sorted(s) for s in owners.values()]
        self.widths = sorted({min(shingle, len(c)) for c in self.codes})
        per = [shingle_keys(c, min(shingle, len(c))) for c in self.codes]
        self.all_keys = np.unique(np.concatenate(per)) if per else np.zeros(0, np.uint64)
        self._per = per

    def order(self, rarity: dict[int, int]) -> None:
        """Choose each window's rarest shingle; index the windows by it."""
        first, at = [], []
        for keys in self._per:
            rank = [(rarity.get(int(k), 0), int(k)) for k in keys]
            o = min(range(len(rank)), key=rank.__getitem__)
            first.append(rank[o][1])
            at.append(o)
        by = np.argsort(np.array(first, dtype=np.uint64), kind="stable")
        self.keys, starts = np.unique(np.array(first, dtype=np.uint64)[by], return_index=True)
        self.lists = np.append(starts, len(by))
        self.win, self.offset = by, np.array(at, dtype=np.int64)[by]
        self.length = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.matrix = np.zeros((len(self.codes), self.window), dtype=np.int64)
        for i, c in enumerate(self.codes):
            self.matrix[i, :len(c)] = c

    def code(self, words: list[bytes]) -> np.ndarray:
        get = self.vocab.get
        return np.array([get(w, 0) for w in words], dtype=np.int64)

    def seen(self, words: list[bytes]) -> np.ndarray:
        """Places in ``all_keys`` of the shingles that occur in a document, each once."""
        codes, got = self.code(words), []
        for width in self.widths:
            keys = shingle_keys(codes, width)
            keys = keys[keys > 0]  # few have only words of the block
            slot = np.minimum(np.searchsorted(self.all_keys, keys), len(self.all_keys) - 1)
            got.append(slot[self.all_keys[slot] == keys])
        return np.unique(np.concatenate(got)) if got else np.zeros(0, np.int64)

    def occurrences(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence in a document."""
        codes, n = self.code(words), len(words)
        padded = np.append(codes, np.zeros(self.window, dtype=np.int64))
        found_w, found_s = [], []
        for width in self.widths if len(self.keys) else []:
            keys = shingle_keys(codes, width)
            slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            met = np.flatnonzero((self.keys[slot] == keys) & (keys > 0))
            for k in range(0, len(met), 4096):  # bounded: a chunk of positions at a time
                p = met[k:k + 4096]
                lo, size = self.lists[slot[p]], np.diff(self.lists)[slot[p]]
                pos = np.repeat(p, size)
                ids = np.repeat(lo - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
                win, start = self.win[ids], pos - self.offset[ids]
                fits = (start >= 0) & (start + self.length[win] <= n)
                fits &= np.minimum(self.length[win], self.shingle) == width
                win, start = win[fits], start[fits]
                for c in range(self.window):  # word by word; most candidates stay
                    same = (padded[start + c] == self.matrix[win, c]) | (c >= self.length[win])
                    win, start = win[same], start[same]
                found_w.append(win)
                found_s.append(start)
        if not found_w:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_w), np.concatenate(found_s)

    def hits(self, words: list[bytes]) -> tuple[list[str], list[list[int]]]:
        """Items with an occurring window, and the hit word ranges (end exclusive)."""
        win, start = self.occurrences(words)
        if not len(win):
            return [], []
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(depth, start, 1)
        np.add.at(depth, start + self.length[win], -1)
        inside = np.concatenate(([0], (np.cumsum(depth[:-1]) > 0).astype(np.int8), [0]))
        edge = np.flatnonzero(np.diff(inside))
        items = sorted({o for w in np.unique(win) for o in self.owners[w]})
        return items, edge.reshape(-1, 2).tolist()


def item_blocks(items: DataFrame, id_col: str, text_col: str,
                block_chars: int) -> list[DataFrame]:
    """The benchmark as blocks of about ``block_chars`` characters, repeated rows once."""
    rows = items.select(F.col(id_col).cast("string").alias("item"),
                        F.col(text_col).alias("text")).distinct()
    chars = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 16)).first()[0] or 0
    blocks = max(1, -(-int(chars) // block_chars))
    if blocks == 1:
        return [rows]
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    return [rows.filter(block == b) for b in range(blocks)]


def prepared(texts: DataFrame, block: DataFrame, window: int, shingle: int):
    """One block's windows, broadcast, with their order by rarity over all ``texts``."""
    context = texts.sparkSession.sparkContext
    # one block of the query set, of bounded size, is read here
    index = Windows([(r["item"] or "", r["text"]) for r in block.collect()], window, shingle)
    sent = context.broadcast(index)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = sent.value
        total = np.zeros(len(ix.all_keys), dtype=np.int64)
        for b in batches:
            for text in b["text"]:
                total[ix.seen(words_of(text))] += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"key": ix.all_keys[at].view(np.int64), "n": total[at]})

    # at most one row per shingle of the block comes back
    rarity = (texts.select("text").mapInPandas(count, "key long, n long")
              .groupBy("key").agg(F.sum("n").alias("n")).collect())
    index.order({r["key"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in rarity})
    return context.broadcast(index)


def _scan(docs: DataFrame, ordered) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix = ordered.value
        for b in batches:
            rows = []
            for doc, copy, text in zip(b["doc_id"], b["digest"], b["text"]):
                words = words_of(text)
                rows.append((doc, copy, len(words), *ix.hits(words)))
            out = pd.DataFrame(rows, columns=["doc_id", "digest", "n_words", "items", "spans"])
            yield out.astype({"digest": "int64"})

    return with_long_id(docs.withColumn("doc_id", id_text("doc_id")).mapInPandas(
        find, "doc_id string, digest long, n_words long, items array<string>, "
              "spans array<array<long>>"))


def _occurs(sent):
    @F.pandas_udf("boolean")
    def occurs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([len(sent.value.occurrences(words_of(t))[0]) > 0 for t in b], dtype=bool)

    return occurs


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                    shingle: int = 3, block_chars: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` in which no window of any item occurs; all columns stay."""
    texts = docs.select(F.col(text_col).alias("text"))
    for block in item_blocks(items, item_col, item_text_col, block_chars):
        ordered = prepared(texts, block, window, shingle)
        docs = docs.filter(~_occurs(ordered)(F.col(text_col)))
    return docs


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, shingle: int = 3,
                  block_chars: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, item_ids, spans.

    item_ids are the items with an occurring window, distinct, sorted as
    strings; spans the hit ranges of words, end exclusive. Null and empty
    texts have no words and no hits, items without words have no window, a
    null item id counts as the empty string, repeated items and windows count
    once, repeated documents each get a row. Empty tables are allowed on both
    sides; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("digest"))
    parts = [_scan(rows, prepared(rows, b, window, shingle))
             for b in item_blocks(items, item_col, item_text_col, block_chars)]
    out = parts[0]
    if len(parts) > 1:  # unite what each block found in a document
        key = ["doc_id", "digest"]
        found = parts[0].filter("size(items) > 0")
        for p in parts[1:]:
            found = found.unionByName(p.filter("size(items) > 0"))
        hit = F.array_distinct(F.flatten(F.transform(
            F.flatten(F.collect_set("spans")),
            lambda s: F.sequence(s[0], s[1] - F.lit(1)))))
        merged = (found.groupBy(*key)
                  .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                       F.array_sort(hit).alias("at")))
        runs = F.filter(F.transform("at", lambda x, i: F.when(
            (i == 0) | (F.element_at("at", i) != x - 1), x)), lambda x: x.isNotNull())
        ends = F.filter(F.transform("at", lambda x, i: F.when(
            (i == F.size("at") - 1) | (F.get("at", i + 1) != x + 1), x + 1)),
            lambda x: x.isNotNull())
        merged = merged.select(*key, "items", F.zip_with(
            runs, ends, lambda a, b: F.array(a, b)).alias("spans"))
        out = parts[0].select("doc_id", "digest", "n_words")
        out = (out.join(merged.withColumnRenamed("doc_id", "doc").withColumnRenamed("digest", "copy"),
                        out.doc_id.eqNullSafe(F.col("doc")) & (out.digest == F.col("copy")), "left")
               .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
               .withColumn("spans", F.coalesce("spans", F.array().cast("array<array<long>>"))))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.col("items").alias("item_ids"), "spans")
