"""Fill-in-the-middle transformation with a sparse exception index.

Texts are cut as UTF-8 bytes, while cuts are asked for and reported in code
points. Nearly all characters are one byte, so a text's index holds only the
exceptions: where its multibyte characters are, and how many bytes they have
in excess so far. A binary search in it turns a byte cut into a code-point cut
and back; a span without exceptions is plain arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.llm.common import text_slices

MARKS = (b"<P>", b"<S>", b"<M>")


class Exceptions:
    """Multibyte characters of a UTF-8 text: byte position, code-point position, excess up to each."""

    def __init__(self, text: bytes):
        self.size = len(text)
        if text.isascii():
            self.at = self.excess = self.char = np.zeros(0, np.int64)
            return
        b = np.frombuffer(text, np.uint8)
        self.at = np.flatnonzero(b >= 0xC0)
        more = 1 + (b[self.at] >= 0xE0).astype(np.int64) + (b[self.at] >= 0xF0)
        self.excess = np.cumsum(more)  # with that character's own
        self.char = self.at - (self.excess - more)

    def chars(self, byte: int) -> int:
        """Code points before a byte position that begins a character (or is the end)."""
        i = int(np.searchsorted(self.at, byte, side="left"))
        return byte - (int(self.excess[i - 1]) if i else 0)

    def bytes(self, char: int) -> int:
        """Byte position of a code point (or the end)."""
        i = int(np.searchsorted(self.char, char, side="left"))
        return char + (int(self.excess[i - 1]) if i else 0)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return np.frombuffer(digest, ">u4", 4).tolist()


def cut(text: bytes, unit: str, first: int, second: int) -> tuple[int, int, int, Exceptions]:
    """(units, byte where the prefix ends, byte where the middle ends, index) for two draws."""
    index = Exceptions(text)
    if unit == "char":
        n = index.chars(len(text))
        low, high = sorted((first % (n + 1), second % (n + 1)))
        return n, index.bytes(low), index.bytes(high), index
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    n = len(ends)
    low, high = (int(ends[k - 1]) if k else 0 for k in sorted((first % (n + 1), second % (n + 1))))
    return n, low, high, index


def transform(doc_id: int | None, text: bytes, unit: str, seed: int, rate: int, spm: int):
    """(units, form, output, code points of prefix and of middle) of one text."""
    h = draws(doc_id, seed)
    n, low, high, index = cut(text, unit, h[0], h[1])
    if not text or h[2] % 100 >= rate or any(m in text for m in MARKS):
        return n, "plain", text, None, None
    start = index.chars(low)
    p, s, m = MARKS
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < spm:
        form, output = "spm", b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, output = "psm", b"".join((p, prefix, s, suffix, m, middle))
    return n, form, output, start, index.chars(high) - start


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                   seed: int = 7, rate: int = 100, spm: int = 50, batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n (units), form, output, prefix_chars, middle_chars.

    unit: "line" (a line with its line feed, or a last one without) or "char".
    The two cuts are drawn among all places between units by a hash of seed and
    id. Forms: ``psm`` prefix, suffix, middle; ``spm`` suffix, prefix, middle;
    ``plain``, the text as it is, where it is empty, holds a mark or the draw is
    not below ``rate`` percent; then the code-point counts are null. spm:
    percent of the rest. Null texts count as empty, a null id draws as ''; repeated rows
    and ids draw alike and keep their rows. Ids are integers of up to 64 bits.
    An empty table gives no rows; other columns are not read.
    """
    if unit not in ("line", "char"):
        raise ValueError("unit must be line or char")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in text_slices(b["text"], batch_bytes):
                ids = b["doc_id"].slice(i, j - i)
                texts = b["text"].slice(i, j - i).cast(pa.binary()).to_pylist()
                rows = [transform(d, t or b"", unit, seed, rate, spm) for d, t in zip(ids.to_pylist(), texts)]
                n, form, output, prefix, middle = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(output, pa.binary()).cast(pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64())],
                    names=["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, output string, prefix_chars long, middle_chars long")


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of. A mark in an output is one that was put there: texts
    that hold one stay plain, and none arises where a text and a mark meet."""
    body = F.substring(output, 4, 1 << 30)
    psm, spm = F.split(body, "<[SM]>", -1), F.split(body, "<[PM]>", -1)
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
            .otherwise(F.concat(spm[1], spm[2], spm[0])))
