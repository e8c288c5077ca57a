"""Personal data: rules, and a character-level bidirectional LSTM with a CRF.

The rules find emails, IP addresses, card numbers and phone numbers. The model
is a small BiLSTM over character classes with a linear-chain CRF on top,
trained in numpy (backpropagation through time, Adam) on labelled spans. It
tags characters with begin / inside marks of the four kinds.

A span of these kinds holds a digit or an at sign, so only the surroundings of
such characters are read by the model; the whole text is searched for them.
Surroundings are cut into overlapping windows. Each window is decoded by
Viterbi; every character takes its tag from the window in whose middle it lies
closest, the tags of a text are put together, and the spans are read off the
whole sequence, so a span across windows is found as one. Model spans that
overlap a rule's span, or that lack the digits or marks of their kind, go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.common import id_text, with_long_id

KINDS = ["email", "ip", "card", "phone"]
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
WINDOW, STRIDE, CONTEXT = 64, 32, 32

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: a failing start inside a run of digits fails at the run's start too
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]+")
_ADDRESS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def rule_spans(text: str) -> list[Span]:
    """The rules' spans: per kind leftmost and non-overlapping, in order."""
    out: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:  # runs before different at signs are disjoint
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if not _ANCHOR.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return in_order(out)


# -- the model ---------------------------------------------------------------

_MARKS = " \n.@+-()_%/:,#|&*$!?'\"<>[]{}="
_CLASSES = 6 + len(_MARKS)  # pad, other, digit, lower, upper, non-ASCII letter, marks


def _char_class(c: str) -> int:
    if "0" <= c <= "9":
        return 2
    if "a" <= c <= "z":
        return 3
    if "A" <= c <= "Z":
        return 4
    k = _MARKS.find(c)
    return 6 + k if k >= 0 else 5 if c.isalpha() else 1


def classes(text: str, cache: dict[str, int] = {}) -> np.ndarray:  # noqa: B006
    """Character classes of a text; the cache holds ASCII only."""
    if not cache:
        cache.update((chr(i), _char_class(chr(i))) for i in range(128))
    return np.array([cache[c] if c in cache else _char_class(c) for c in text], dtype=np.int64)


def _allowed() -> np.ndarray:
    """Which tag may follow which: inside only after begin or inside of its kind."""
    ok = np.ones((len(TAGS), len(TAGS)), dtype=bool)
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            ok[:, j] = [s != "O" and s[2:] == t[2:] for s in TAGS]
    return ok


_FORBIDDEN = np.where(_allowed(), 0.0, -1e4)
_START = np.array([-1e4 if t[0] == "I" else 0.0 for t in TAGS])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class BiLstmCrf:
    def __init__(self, dim: int = 10, hidden: int = 14, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.h = hidden
        g = lambda *s: rng.standard_normal(s) / np.sqrt(s[0])
        self.p = {"emb": rng.standard_normal((_CLASSES, dim)) * 0.5}
        for d in "fb":
            self.p |= {f"w{d}": g(dim, 4 * hidden), f"u{d}": g(hidden, 4 * hidden),
                       f"c{d}": np.r_[np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]}
        self.p |= {"out": g(2 * hidden, len(TAGS)), "bias": np.zeros(len(TAGS)),
                   "trans": np.zeros((len(TAGS), len(TAGS)))}

    def _lstm(self, x: np.ndarray, d: str) -> tuple:
        """x: [time, batch, dim]; gates in the order input, forget, output, cell."""
        n, b, h = x.shape[0], x.shape[1], self.h
        pre = x @ self.p["w" + d] + self.p["c" + d]
        hs, cs = np.zeros((n + 1, b, h)), np.zeros((n + 1, b, h))
        gates = np.empty((n, b, 4 * h))
        for t in range(n):
            z = pre[t] + hs[t] @ self.p["u" + d]
            gates[t, :, :3 * h] = _sigmoid(z[:, :3 * h])
            gates[t, :, 3 * h:] = np.tanh(z[:, 3 * h:])
            i, f, o, c = np.split(gates[t], 4, axis=1)
            cs[t + 1] = f * cs[t] + i * c
            hs[t + 1] = o * np.tanh(cs[t + 1])
        return hs, cs, gates

    def _lstm_back(self, x, run, dh, d, grad) -> np.ndarray:
        hs, cs, gates = run
        h = self.h
        dz = np.empty_like(gates)
        later_h, later_c = np.zeros_like(hs[0]), np.zeros_like(cs[0])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, c = np.split(gates[t], 4, axis=1)
            tc = np.tanh(cs[t + 1])
            g = dh[t] + later_h
            dc = later_c + g * o * (1 - tc * tc)
            dz[t, :, :h] = dc * c * i * (1 - i)
            dz[t, :, h:2 * h] = dc * cs[t] * f * (1 - f)
            dz[t, :, 2 * h:3 * h] = g * tc * o * (1 - o)
            dz[t, :, 3 * h:] = dc * i * (1 - c * c)
            later_c, later_h = dc * f, dz[t] @ self.p["u" + d].T
        flat = dz.reshape(-1, 4 * h)
        grad["w" + d] = x.reshape(-1, x.shape[2]).T @ flat
        grad["u" + d] = hs[:-1].reshape(-1, h).T @ flat
        grad["c" + d] = flat.sum(axis=0)
        return dz @ self.p["w" + d].T

    def emissions(self, chars: np.ndarray) -> tuple:
        """chars [batch, time] -> scores [time, batch, tags] and what training needs."""
        x = self.p["emb"][chars.T]
        fwd, bwd = self._lstm(x, "f"), self._lstm(x[::-1], "b")
        both = np.concatenate([fwd[0][1:], bwd[0][1:][::-1]], axis=2)
        return both @ self.p["out"] + self.p["bias"], (x, fwd, bwd, both)

    def loss_and_grad(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the CRF, and its gradient."""
        e, (x, fwd, bwd, both) = self.emissions(chars)
        n, b, k = e.shape
        y = tags.T
        trans = self.p["trans"] + _FORBIDDEN
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + _START
        for t in range(1, n):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(n - 2, -1, -1):
            beta[t] = _lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        logz = _lse(alpha[-1], 1)
        cols = np.arange(b)
        path = e[0, cols, y[0]] + _START[y[0]]
        d_trans = np.zeros_like(trans)
        for t in range(1, n):
            path += trans[y[t - 1], y[t]] + e[t, cols, y[t]]
            pair = np.exp(alpha[t - 1][:, :, None] + trans
                          + (e[t] + beta[t])[:, None, :] - logz[:, None, None])
            d_trans += pair.sum(axis=0)
            np.add.at(d_trans, (y[t - 1], y[t]), -1.0)
        de = np.exp(alpha + beta - logz[:, None])
        de[np.arange(n)[:, None], cols[None, :], y] -= 1
        de /= b
        grad = {"trans": d_trans / b, "bias": de.sum(axis=(0, 1)),
                "out": both.reshape(-1, both.shape[2]).T @ de.reshape(-1, k)}
        dboth = de @ self.p["out"].T
        dx = self._lstm_back(x, fwd, dboth[:, :, :self.h], "f", grad)
        dx += self._lstm_back(x[::-1], bwd, dboth[::-1, :, self.h:], "b", grad)[::-1]
        grad["emb"] = np.zeros_like(self.p["emb"])
        np.add.at(grad["emb"], chars.T, dx)
        return float((logz - path).mean()), grad

    def fit(self, chars: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 64,
            rate: float = 0.02, seed: int = 5) -> float:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, loss = 0, 0.0
        for _ in range(epochs):
            order = rng.permutation(len(chars))
            for i in range(0, len(order), batch):
                at = order[i:i + batch]
                loss, grad = self.loss_and_grad(chars[at], tags[at])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-8)
        return loss

    def decode(self, chars: np.ndarray) -> np.ndarray:
        """Best tags [batch, time] by Viterbi."""
        e, _ = self.emissions(chars)
        n, b, k = e.shape
        trans = self.p["trans"] + _FORBIDDEN
        best, back = e[0] + _START, np.empty((n, b, k), dtype=np.int8)
        for t in range(1, n):
            all_ = best[:, :, None] + trans
            back[t] = all_.argmax(axis=1)
            best = all_.max(axis=1) + e[t]
        out = np.empty((n, b), dtype=np.int8)
        out[-1] = best.argmax(axis=1)
        for t in range(n - 1, 0, -1):
            out[t - 1] = back[t, np.arange(b), out[t]]
        return out.T


# -- windows -----------------------------------------------------------------

def regions(text: str) -> list[tuple[int, int]]:
    """Surroundings of digits and at signs, merged; an edge inside a run of address
    characters moves out to the end of that run, so that no address is cut."""
    near: list[tuple[int, int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if near and a <= near[-1][1]:
            near[-1] = near[-1][0], b
        else:
            near.append((a, b))
    out: list[tuple[int, int]] = []
    for a, b in near:
        done = out[-1][1] if out else 0
        if text[a] in _ADDRESS:
            while a > done and text[a - 1] in _ADDRESS:
                a -= 1
        b = max(b, done)
        if b > done and text[b - 1] in _ADDRESS:
            while b < len(text) and text[b] in _ADDRESS:
                b += 1
        if out and a <= done:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def window_starts(a: int, b: int) -> list[int]:
    return list(range(a, max(a + 1, b - WINDOW + STRIDE), STRIDE))


def _plausible(kind: str, s: str) -> bool:
    d = len(_digits(s))
    return {"email": "@" in s[1:-1], "ip": s.count(".") == 3 and d >= 4,
            "card": 14 <= d <= 19 and luhn(_digits(s)), "phone": 7 <= d <= 15}[kind]


def model_spans(model: BiLstmCrf, texts: list[str], chunk: int = 256) -> list[list[Span]]:
    """Spans of the model alone, for several texts at once."""
    jobs = []  # (text number, region, window start)
    for k, t in enumerate(texts):
        for a, b in regions(t):
            jobs += [(k, a, b, s) for s in window_starts(a, b)]
    out: list[list[Span]] = [[] for _ in texts]
    tags: dict[tuple[int, int, int], np.ndarray] = {}

    def close(key: tuple[int, int, int]) -> None:
        k, a, _ = key
        seq, text, i = tags.pop(key), texts[key[0]], 0
        while i < len(seq):
            if seq[i] == 0:
                i += 1
                continue
            kind, j = (seq[i] - 1) // 2, i + 1
            while j < len(seq) and seq[j] == 2 * kind + 2:
                j += 1
            s = text[a + i:a + j]
            lead = len(s) - len(s.lstrip())
            if _plausible(KINDS[kind], s.strip()):
                out[k].append((KINDS[kind], a + i + lead, a + i + lead + len(s.strip())))
            i = j

    for i in range(0, len(jobs), chunk):
        part = jobs[i:i + chunk]
        chars = np.zeros((len(part), WINDOW), dtype=np.int64)
        for r, (k, a, b, s) in enumerate(part):
            c = classes(texts[k][s:min(b, s + WINDOW)])
            chars[r, :len(c)] = c
        for (k, a, b, s), best in zip(part, model.decode(chars)):
            key = (k, a, b)
            seq = tags.setdefault(key, np.zeros(b - a, dtype=np.int8))
            # a window owns its middle; the first and the last also own the ends
            lo = a if s == a else s + (WINDOW - STRIDE) // 2
            last = s + WINDOW >= b
            hi = b if last else s + (WINDOW + STRIDE) // 2
            seq[lo - a:hi - a] = best[lo - s:hi - s]
            if last:
                close(key)
    return out


def find_spans(model: BiLstmCrf | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(rule spans, all spans) of each text."""
    base = [rule_spans(t) for t in texts]
    more = model_spans(model, texts) if model else [[] for _ in texts]
    out = []
    for b, extra in zip(base, more):
        kept, spans, i = list(b), in_order(b), 0
        reach = 0
        for s in sorted(extra, key=lambda s: (s[1], -s[2])):
            while i < len(spans) and spans[i][1] <= s[1]:
                reach = max(reach, spans[i][2])
                i += 1
            ahead = spans[i][1] if i < len(spans) else s[2]
            if s[1] >= reach and s[2] <= ahead:
                kept.append(s)
                reach = s[2]
        out.append((b, in_order(kept)))
    return out


# -- training ----------------------------------------------------------------

def labelled(text: str, spans: list[Span]) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of one training text of at most WINDOW characters."""
    chars, tags = np.zeros(WINDOW, dtype=np.int64), np.zeros(WINDOW, dtype=np.int64)
    c = classes(text[:WINDOW])
    chars[:len(c)] = c
    for kind, a, b in spans:
        if a < WINDOW:
            tags[a:b] = 2 * KINDS.index(kind) + 2
            tags[a] -= 1
    return chars, tags


def made_examples(words: list[str], n: int, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Labelled spans written into runs of plain words: the four kinds, also in
    forms that the rules leave out, and look-alikes without a label."""
    rng = np.random.default_rng(seed)
    words = words or ["word"]
    pick = lambda: words[int(rng.integers(len(words)))]
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    name = lambda: re.sub("[^a-z]", "", pick().lower()) or "name"

    def card() -> str:
        d = num(int(rng.integers(13, 16)))
        d += next(str(k) for k in range(10) if luhn(d + str(k)))
        sep = ("", " ", "-")[int(rng.integers(3))]
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return (f"+{rng.integers(1, 99)} ({a}) {b}-{c}", f"+{rng.integers(1, 99)} {a} {b} {c}",
                f"({a}) {b}-{c}", f"+{rng.integers(1, 9)}-{a}-{b}-{c}")[int(rng.integers(4))]

    def email() -> str:
        host = f"{name()}.{('com', 'org', 'net', 'example')[int(rng.integers(4))]}"
        user = f"{name()}{('', '.' + name(), num(2))[int(rng.integers(3))]}"
        return f"{user}{('@', '@', '@', ' @ ')[int(rng.integers(4))]}{host}"

    make = {"email": email, "card": card, "phone": phone,
            "ip": lambda: ".".join(str(x) for x in rng.integers(0, 256, 4))}
    out = []
    for i in range(n):
        text, spans = " ".join(pick() for _ in range(int(rng.integers(0, 4)))), []
        kind = [*KINDS, None][i % 5]
        text += " " if text else ""
        if kind:
            value = make[kind]()
            spans.append((kind, len(text), len(text) + len(value)))
        else:
            value = (num(int(rng.integers(1, 7))), f"{num(4)}-{num(2)}-{num(2)}", f"{num(1)}.{num(2)}",
                     f"@{name()}", f"0x{num(8)}f{num(6)}a", f"{num(3)}!")[int(rng.integers(6))]
        text += value + ("", ".", ",", "!")[int(rng.integers(4))]
        text += "".join(" " + pick() for _ in range(int(rng.integers(0, 5))))
        out.append((text, spans))
    return out


def train(examples: list[tuple[str, list[Span]]], epochs: int = 6) -> BiLstmCrf:
    """Fit a model on labelled texts, in windows of a window's length."""
    rows = []
    for text, spans in examples:
        for s in range(0, max(1, len(text) - STRIDE), STRIDE):
            inside = [(k, max(a - s, 0), min(b - s, WINDOW)) for k, a, b in spans
                      if a < s + WINDOW and b > s]
            rows.append(labelled(text[s:s + WINDOW], inside))
    model = BiLstmCrf()
    if rows:
        model.fit(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), epochs)
    return model


def training_examples(docs: DataFrame, text_col: str = "text", sample: int = 250,
                      made: int = 350) -> list[tuple[str, list[Span]]]:
    """At most ``sample`` documents that hold a digit or an at sign, chosen by a hash,
    give their first surroundings with the rules' spans as labels; ``made``
    more are written from their words."""
    piece = F.regexp_extract(F.col(text_col), f"(?s).{{0,{CONTEXT}}}[0-9@].{{0,{2 * CONTEXT}}}", 0)
    rows = (docs.filter(F.col(text_col).rlike("[0-9@]"))
            .select(F.xxhash64(text_col).alias("h"), piece.alias("piece"))
            .dropDuplicates(["h"]).orderBy("h").limit(sample).collect())
    pieces = [r["piece"] for r in rows]
    words = [w for p in pieces for w in p.split() if w.isalpha()]
    return [(p, rule_spans(p)) for p in pieces] + made_examples(words, made)


def personal_data(docs: DataFrame, model: BiLstmCrf | None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base (the rules' spans), all_spans (kind, start,
    end in code points, end exclusive), both in order.

    Null texts count as empty; repeated documents each get a row; a null id
    keeps its row. Other columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = find_spans(model, ["" if t is None else t for t in b["text"]])
            rows = [[[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in pair]
                    for pair in found]
            yield pd.DataFrame({"doc_id": b["doc_id"],
                                "base": [r[0] for r in rows], "all_spans": [r[1] for r in rows]})

    span = "array<struct<kind:string,start:long,end:long>>"
    return with_long_id(
        docs.select(id_text(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInPandas(run, f"doc_id string, base {span}, all_spans {span}"))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in in_order(spans):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
