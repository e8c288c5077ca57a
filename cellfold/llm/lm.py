"""Language-model scores by deleted interpolation.

    P(w | h) = l2[b] c(h w) / c(h) + l1[b] c(w) / N + l0[b] / (V + 1),   b = bucket of c(h)

mixes maximum-likelihood estimates of a bigram, a unigram and a uniform model
with weights that depend on how often the context h was seen (buckets double
in width). The weights are learned by expectation-maximisation on a deleted
part of the training documents, against counts taken without that part; the
documents are then scored with the counts of all training documents.

Counting and look-up are one exchange. Documents are cut into blocks of about
``block_words`` tokens, all of one part (retained, deleted, held out). A block
sends each distinct word and bigram it holds once, as a 64-bit hash with its
count, to a shard that owns a range of hashes (so a frequent n-gram reaches
its shard once per block, already added up); the shard adds the counts and
answers with the totals, in the order in which they were asked for. Blocks and
answers are written to reliable checkpoints, so a lost executor costs only the
tasks it ran. The number of shards follows the size of the corpus, so shards
and blocks stay bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.blobs import pack, pack_sorted, unpack, unpack_sorted
from cellfold.llm.common import ascii_words, checkpoint, doc_fold, id_text, with_long_id

RETAINED, DELETED, HELD_OUT = 0, 1, 2
END = xxhash.xxh64_intdigest(b"", 1)  # no word is empty
_MIX = np.uint64(0x9E3779B97F4A7C15)
BUCKETS = 40

_BLOCKS = ("block long, part int, docs array<string>, lens binary, n_tokens long, "
           "codes binary, hashes binary")


class Block:
    """Token codes of some documents, and the hashes of the block's own vocabulary.

    Code 0 is the end token, which is also the context of a first word.
    """

    def __init__(self, lens: np.ndarray, codes: np.ndarray, hashes: np.ndarray):
        self.lens, self.codes = lens.astype(np.int64), codes.astype(np.int64)
        context = np.roll(self.codes, 1)
        context[np.cumsum(self.lens) - self.lens] = 0
        pair, self.inverse, self.n = np.unique(context * len(hashes) + self.codes,
                                               return_inverse=True, return_counts=True)
        self.first, self.second = pair // len(hashes), pair % len(hashes)
        joint = (hashes[self.first] ^ (hashes[self.first] >> np.uint64(31))) * _MIX + hashes[self.second]
        joint = (joint ^ (joint >> np.uint64(29))) * _MIX
        # lowest bit: 0 for a word, 1 for a bigram
        keys = np.concatenate([hashes & ~np.uint64(1), joint | np.uint64(1)])
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        words = np.bincount(self.codes, minlength=len(hashes))
        self.counts = np.concatenate([words, self.n])[self.order]

    def slices(self, shards: int) -> list[tuple[int, int, int]]:
        """(shard, start, stop) of the sorted keys; shards own equal ranges of hashes."""
        shard = ((self.keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        ids, start = np.unique(shard, return_index=True)
        return list(zip(ids.tolist(), start.tolist(), [*start[1:].tolist(), len(shard)]))

    def split(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Answers in key order, put back as (per word, per distinct bigram)."""
        back = np.empty(len(totals), dtype=np.int64)
        back[self.order] = totals.astype(np.int64)
        n_words = len(back) - len(self.n)
        return back[:n_words], back[n_words:]


def blocks_of(docs: DataFrame, block_words: int) -> DataFrame:
    """One row per block of (doc_id, text, part)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, seq = TaskContext.get().partitionId(), 0
        ids: dict[int, list] = {p: [] for p in (RETAINED, DELETED, HELD_OUT)}
        texts: dict[int, list] = {p: [] for p in ids}
        size = dict.fromkeys(ids, 0)

        def flush(part: int) -> pd.DataFrame:
            nonlocal seq
            vocab: dict[bytes, int] = {b"": 0}
            codes, lens = [], []
            for words in texts[part]:
                codes += [vocab.setdefault(w, len(vocab)) for w in words]
                codes.append(0)
                lens.append(len(words) + 1)
            hashes = np.array([END] + [xxhash.xxh64_intdigest(w) for w in vocab][1:], dtype=np.uint64)
            row = (task << 32 | seq, part, ids[part], pack(np.array(lens)), len(codes),
                   pack(np.array(codes)), hashes.tobytes())
            seq += 1
            ids[part], texts[part], size[part] = [], [], 0
            return pd.DataFrame([row], columns=[c.split()[0] for c in _BLOCKS.split(", ")])

        for b in batches:
            for doc, text, part in zip(b["doc_id"], b["text"], b["part"]):
                words = ascii_words(text)
                ids[part].append(None if pd.isna(doc) else doc)
                texts[part].append(words)
                size[part] += len(words) + 1
                if size[part] >= block_words:
                    yield flush(part)
        for part in ids:
            if ids[part]:
                yield flush(part)

    return docs.mapInPandas(run, _BLOCKS)


def _block(row) -> Block:
    return Block(unpack(row["lens"]), unpack(row["codes"]),
                 np.frombuffer(row["hashes"], dtype=np.uint64))


def look_up(blocks: DataFrame, shards: int) -> DataFrame:
    """(block, shard, part, total, retained): for each block and shard the training and
    the retained counts of what the block asked for. Rows with block -1 hold a
    shard's number of distinct training words in ``part``."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, r in b.iterrows():
                k = _block(r)
                yield pd.DataFrame([(r["block"], s, r["part"], pack_sorted(k.keys[i:j]),
                                     pack(k.counts[i:j])) for s, i, j in k.slices(shards)],
                                   columns=["block", "shard", "part", "keys", "counts"])

    def answer(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in g["keys"]]
        sizes = [len(k) for k in keys]
        own, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([unpack(x) for x in g["counts"]]).astype(np.int64)
        part = np.repeat(g["part"].to_numpy(), sizes)
        total, retained = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        np.add.at(total, inverse[part != HELD_OUT], counts[part != HELD_OUT])
        np.add.at(retained, inverse[part == RETAINED], counts[part == RETAINED])
        words = int(((own & np.uint64(1) == 0) & (total > 0)).sum())
        rows, at = [(-1, key[0], words, None, None)], 0
        for block, p, n in zip(g["block"], g["part"], sizes):
            i = inverse[at:at + n]
            rows.append((block, key[0], p, pack(total[i]),
                         pack(retained[i]) if p == DELETED else None))
            at += n
        return pd.DataFrame(rows, columns=["block", "shard", "part", "total", "retained"])

    return (blocks.mapInPandas(ask, "block long, shard long, part int, keys binary, counts binary")
            .groupBy("shard").applyInPandas(
                answer, "block long, shard long, part int, total binary, retained binary"))


def _answers(g: pd.DataFrame, column: str) -> np.ndarray:
    g = g.sort_values("shard")
    return np.concatenate([unpack(x) for x in g[column]])


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """0 for a count of 0, else the number of binary digits."""
    return np.frexp(counts.astype(np.float64))[1].clip(0, BUCKETS - 1)


def estimates(words: np.ndarray, pairs: np.ndarray, block: Block, n: int,
              v: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, the three probabilities) of each distinct bigram of a block."""
    context = words[block.first]
    p = np.empty((len(pairs), 3))
    p[:, 0] = 1 / (v + 1)
    p[:, 1] = words[block.second] / max(n, 1)
    p[:, 2] = np.divide(pairs, context, out=np.zeros(len(pairs)), where=context > 0)
    return bucket_of(context), p


def learn_weights(held: DataFrame, rounds: int, tolerance: float = 1e-6) -> np.ndarray:
    """EM over rows of (bucket, p, n) arrays of the deleted part: weights [bucket, order].

    Only the sums per bucket and order (a fixed small table) reach the driver.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = [0.5, 0.5, 0.0]
    last = -np.inf
    for _ in range(rounds):
        now = weights.copy()

        def expect(batches: Iterator[pd.DataFrame], w: np.ndarray = now) -> Iterator[pd.DataFrame]:
            sums, like = np.zeros((BUCKETS, 3)), 0.0
            for b in batches:
                for bucket, p, n in zip(b["bucket"], b["p"], b["n"]):
                    bucket = np.frombuffer(bucket, dtype=np.uint8)
                    n = unpack(n).astype(np.float64)
                    share = np.frombuffer(p, dtype=np.float32).reshape(-1, 3) * w[bucket]
                    mass = share.sum(axis=1)
                    like += float(n @ np.log(mass))
                    share *= (n / mass)[:, None]
                    for k in range(3):
                        sums[:, k] += np.bincount(bucket, share[:, k], BUCKETS)
            yield pd.DataFrame({"bucket": np.arange(BUCKETS), "s0": sums[:, 0], "s1": sums[:, 1],
                                "s2": sums[:, 2], "like": like / BUCKETS})

        got = (held.mapInPandas(expect, "bucket long, s0 double, s1 double, s2 double, like double")
               .groupBy("bucket").agg(F.sum("s0"), F.sum("s1"), F.sum("s2"), F.sum("like"))
               .orderBy("bucket").collect())
        if not got:
            break
        sums, like = np.array([r[1:4] for r in got]), sum(r[4] for r in got)
        seen = sums.sum(axis=1)
        overall = sums[1:].sum(axis=0)
        for b in range(BUCKETS):  # a bucket that was never seen takes the overall weights
            if seen[b] > 0:
                weights[b] = sums[b] / seen[b]
            elif b and overall.sum() > 0:
                weights[b] = overall / overall.sum()
        # never quite 0, so that every probability stays positive
        weights[:, 0] = weights[:, 0].clip(1e-6)
        weights[0, 2] = 0
        weights /= weights.sum(axis=1, keepdims=True)
        if like - last < tolerance * abs(like):
            break
        last = like
    return weights


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7,
              held_fold: int = 2, deleted_share: int = 16, rounds: int = 12,
              block_words: int = 1 << 19, shard_chars: int = 6 << 20) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    Learns from documents whose crc32(id as text) mod ``folds`` is not
    ``held_fold``; one in ``deleted_share`` of these is the deleted part.
    Tokens are words and one end token per document. base_score adds up
    log10((c + 1) / (N + V + 1)), score log10 of the interpolated probability.
    Null texts count as empty (the end token alone); a null id hashes as ''
    and keeps its row; repeated documents each count and each get a row. An
    empty table gives no rows. With nothing to learn from, the uniform model
    remains. Other columns are not read.
    """
    part = (F.when(doc_fold(F.col("doc_id"), folds) == held_fold, HELD_OUT)
            .when(F.pmod(F.xxhash64("doc_id"), F.lit(deleted_share)) == 0, DELETED)
            .otherwise(RETAINED))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .withColumn("part", part).withColumn("doc_id", id_text("doc_id"))
    blocks = checkpoint(blocks_of(rows, block_words))
    size = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    tokens = {r["part"]: r["n"] for r in size}
    n_retained = tokens.get(RETAINED, 0)
    n = n_retained + tokens.get(DELETED, 0)
    shards = max(1, sum(tokens.values()) * 6 // shard_chars)
    answers = checkpoint(look_up(blocks, shards))
    v = answers.filter("block = -1").agg(F.sum("part")).first()[0] or 0
    answers = answers.filter("block >= 0")

    def evidence(t: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        k = _block(t.iloc[0])
        bucket, p = estimates(*k.split(_answers(a, "retained")), k, n_retained, v)
        return pd.DataFrame([(bucket.astype(np.uint8).tobytes(), p.astype(np.float32).tobytes(),
                              pack(k.n))], columns=["bucket", "p", "n"])

    held = checkpoint(
        blocks.filter(F.col("part") == DELETED).groupBy("block")
        .cogroup(answers.filter(F.col("part") == DELETED).groupBy("block"))
        .applyInPandas(evidence, "bucket binary, p binary, n binary"))
    weights = learn_weights(held, rounds)
    if n == 0:
        weights[:] = [1.0, 0.0, 0.0]

    def score(t: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        k = _block(t.iloc[0])
        words, pairs = k.split(_answers(a, "total"))
        bucket, p = estimates(words, pairs, k, n, v)
        logp = np.log10((p * weights[bucket]).sum(axis=1))[k.inverse]
        base = np.log10((words + 1) / (n + v + 1))[k.codes]
        known = (words > 0)[k.codes].astype(np.int64)
        at = np.cumsum(k.lens) - k.lens
        return pd.DataFrame({
            "doc_id": t["docs"].iloc[0],
            "held_out": int(t["part"].iloc[0]) == HELD_OUT, "n_tokens": k.lens,
            "n_known": np.add.reduceat(known, at), "train_tokens": n,
            "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(logp, at)})

    return with_long_id(
        blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInPandas(score, "doc_id string, held_out boolean, n_tokens long, n_known long, "
                                  "train_tokens long, base_score double, score double"))
