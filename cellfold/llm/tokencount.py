"""Token counts by dynamic programming over a trie of pre-tokens.

A pre-token's best segmentation under a unigram model (the pieces of a public
vocabulary with a log probability each) is a forward pass over its characters:
best[i] = max over pieces ending at i. Pre-tokens with a common prefix have
the same forward scores along it. The distinct pre-tokens of a batch are put
into a trie; its nodes are visited depth first and each node's forward score
is computed once, however many pre-tokens pass through it. Terminal nodes
store the number of tokens. A document's count is the sum over its pre-tokens.

There is no shuffle: every task builds the trie of its own batches and keeps
the stored counts of earlier ones up to a bound.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.common import id_text, with_long_id

MARK = "▁"  # stands before every pre-token, as in the vocabulary


class Unigram:
    """Log probabilities of pieces; characters outside it fall back to bytes."""

    def __init__(self, pieces: list[str], byte_log_prob: float | None = None):
        """pieces: most probable first. The vocabulary names an order, not
        probabilities, so a piece of rank r gets those of Zipf's law."""
        n = len(pieces)
        total = np.log(np.sum(1.0 / np.arange(1, n + 1))) if n else 0.0
        self.log_prob = {p: float(-np.log(r + 1) - total) for r, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.byte = -2.0 * float(np.log(n + 2)) if byte_log_prob is None else byte_log_prob

    @classmethod
    def from_sentencepiece(cls, path: str) -> "Unigram":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        ids.sort(key=lambda i: (-sp.get_score(i), i))
        return cls([sp.id_to_piece(i) for i in ids])

    def counts(self, pre_tokens: list[str]) -> dict[str, int]:
        """Tokens of each distinct pre-token; ties go to the fewer tokens.

        Sorted pre-tokens are the trie's leaves in depth-first order; the
        columns of the common prefix with the one before are the path that
        both share, and only the nodes below it are computed.
        """
        out: dict[str, int] = {}
        score, tokens = [0.0], [0]  # the path from the root, one entry per node
        path, get, longest, byte = "", self.log_prob.get, self.longest, self.byte
        for word in sorted(set(pre_tokens)):
            full = MARK + word
            shared, most = 0, min(len(full), len(path))
            while shared < most and full[shared] == path[shared]:
                shared += 1
            del score[shared + 1:], tokens[shared + 1:]
            for i in range(shared + 1, len(full) + 1):
                size = len(full[i - 1].encode("utf-8", "surrogatepass"))
                best, least = score[i - 1] + byte * size, tokens[i - 1] + size
                for j in range(max(0, i - longest), i):
                    p = get(full[j:i])
                    if p is not None:
                        s = score[j] + p
                        if s > best or (s == best and tokens[j] + 1 < least):
                            best, least = s, tokens[j] + 1
                score.append(best)
                tokens.append(least)
            path = full
            out[word] = tokens[-1]
        return out


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                 text_col: str = "text", memory: int = 600_000, long_word: int = 1000,
                 batch_chars: int = 4 << 20) -> DataFrame:
    """One row per document: doc_id, n_pre_tokens, n_distinct, n_tokens.

    vocabulary: path of a sentencepiece model, readable by the executors.
    Pre-tokens are runs of characters that are not white space. Null and
    empty texts have none; repeated documents each get a row; a null id keeps
    its row. memory: stored counts a task keeps between batches (at the bound
    it starts anew); pre-tokens over ``long_word`` characters are counted in
    full but not kept; batch_chars: text whose words are in memory at once, at
    least one document. Other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Unigram.from_sentencepiece(vocabulary)
        known: dict[str, int] = {}
        for b in batches:
            size = np.cumsum([len(t or "") for t in b["text"]])
            cuts = [0, *np.flatnonzero(np.diff(size // batch_chars)) + 1, len(b)]
            for i, j in zip(cuts, cuts[1:]):
                bags = [Counter(t.split()) if t else Counter() for t in b["text"][i:j]]
                if len(known) > memory:
                    known.clear()
                new = {w for bag in bags for w in bag if w not in known}
                fresh = model.counts(list(new))
                known.update(fresh)
                yield pd.DataFrame({
                    "doc_id": b["doc_id"][i:j],
                    "n_pre_tokens": [sum(x.values()) for x in bags],
                    "n_distinct": [len(x) for x in bags],
                    "n_tokens": [sum(known[w] * n for w, n in x.items()) for x in bags]})
                for w in [w for w in fresh if len(w) > long_word]:
                    del known[w]

    return with_long_id(
        docs.select(id_text(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInPandas(run, "doc_id string, n_pre_tokens long, n_distinct long, n_tokens long"))
