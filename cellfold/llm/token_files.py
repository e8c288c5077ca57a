"""Token ids written as patched frame-of-reference files in document order.

Documents are tokenised where they are read; only their ids move. They go to
ranges of the document id whose bounds come from a sample of the ids alone;
rows of an id that fills several ranges are dealt over all of them. Each range
is sorted and written as a run of files of bounded size
(``cellfold.llm.pfor``), one row of a Parquet table per file, so Spark's own
commit protocol makes the output whole after lost tasks and any shared store
can hold it.
"""

from __future__ import annotations

import json
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellfold.llm.common import INT64_MIN, sampled_cuts, text_slices
from cellfold.llm.pfor import File, encode_file
from cellfold.session import scratch_path

END_ID = 1
_FILES = "range int, file int, first long, n_docs long, n_ids long, data binary"


def ragged(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs of ``data`` of these starts and lengths, one after the other."""
    before = np.cumsum(lens) - lens
    return data[np.arange(int(lens.sum())) + np.repeat(starts - before, lens)]


class WordEncoder:
    """Ids of whole texts, as the tokenizer gives them.

    Where the tokenizer file states exactly the normaliser, pre-tokenizer and
    model options below, no pre-token spans ASCII white space, and a text's ids
    are those of its white-space separated words one after the other. A batch's
    distinct words are found in Arrow; those of plain Latin letters, digits and
    printable ASCII marks are cut into pieces by the tokenizer's own pattern,
    and each distinct piece goes to its model once (up to ``memory`` pieces are
    kept); all other words go through the whole tokenizer. Any other tokenizer
    file encodes whole texts.
    """

    #: what the file must state for words to be encoded one by one (fixed values)
    NORMALIZER = {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"}]}
    PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {
            "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
    #: printable ASCII, and the Latin-1 letters that lower case and composition leave single
    PLAIN = "^[\x21-\x7eÀ-ÖØ-öø-ÿ]*$"
    #: the tokenizer's split pattern, for those characters in lower case; words end in a line feed
    PIECES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")

    def __init__(self, path: str, memory: int = 800_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model, self.memory = self.tok.model, memory
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        added = said.get("added_tokens") or []
        self.by_word = (said.get("normalizer") == self.NORMALIZER
                        and said.get("pre_tokenizer") == self.PRE_TOKENIZER
                        and said["model"].get("type") == "BPE"
                        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                    or len(t["content"].split()) != 1 for t in added))
        self.special = [t["content"] for t in added]
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        # byte-level alphabet: printable bytes stand for themselves, others from U+0100 on
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self._forget()

    def _forget(self) -> None:
        # known pieces and whole words by number; number 0 is the end of a word and has no ids
        self.pieces: dict[str, int] = {"\n": 0}
        self.whole: dict[str, int] = {}
        self.flat, self.size = array("I"), array("q", [0])

    def _keep(self, ids) -> int:
        before = len(self.flat)
        self.flat.extend(ids)
        self.size.append(len(self.flat) - before)
        return len(self.size) - 1

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, start, length) of distinct words."""
        plain = pc.match_substring_regex(words, self.PLAIN)
        for s in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, s))
        is_plain = plain.to_numpy(zero_copy_only=False)
        known = words.filter(plain)
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(known)], known), "\n")[0].as_py()
        pieces = pa.array(self.PIECES.findall(joined.lower() + "\n" * (len(known) > 0)),
                          pa.string()).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        number = list(map(self.pieces.get, distinct))
        for k, p in enumerate(distinct):
            if number[k] is None:
                number[k] = self.pieces[p] = self._keep(
                    [t.id for t in self.model.tokenize(p if p.isascii() else "".join(
                        map(self.letters.__getitem__, p.encode("utf-8"))))])
        codes = np.array(number, dtype=np.int64)[pieces.indices.to_numpy()]
        others = words.filter(pc.invert(plain)).to_pylist()
        new = [w for w in others if w not in self.whole]
        for i in range(0, len(new), 10_000):
            part = new[i:i + 10_000]
            for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False)):
                self.whole[w] = self._keep(e.ids)
        codes = np.concatenate([codes, [self.whole[w] for w in others]]).astype(np.int64)
        size = np.array(self.size)
        lens, ends = size[codes], np.cumsum(size[codes])
        flat = ragged(np.array(self.flat, dtype=np.uint32), (np.cumsum(size) - size)[codes], lens)
        last = np.empty(len(is_plain), dtype=np.int64)  # where a word's ids end
        last[is_plain] = ends[:len(pieces)][codes[:len(pieces)] == 0]
        last[~is_plain] = ends[len(pieces):]
        order = np.concatenate([np.flatnonzero(is_plain), np.flatnonzero(~is_plain)])
        length = np.empty_like(last)
        length[order] = np.diff(last[order], prepend=0)
        return flat, last - length, length

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after the other, ids of each text); null texts are empty."""
        if not self.by_word:
            ids = [e.ids for e in self.tok.encode_batch_fast(
                [t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return (np.array([i for x in ids for i in x], dtype=np.uint32),
                    np.array([len(x) for x in ids], dtype=np.int64))
        if len(self.size) > self.memory:
            self._forget()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.values.dictionary_encode()
        flat, start, length = self._words(words.dictionary)
        at = words.indices.to_numpy()
        lens = length[at]
        ends = np.concatenate([[0], np.cumsum(lens)])
        return ragged(flat, start[at], lens), np.diff(ends[split.offsets.to_numpy()])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        ids, lens = self.encode_array(pa.array(texts, pa.string()))
        ends = np.cumsum(lens)
        return [ids[e - n:e].astype("<u4").tobytes() for e, n in zip(ends, lens)]

    def encode_long(self, text: bytes, at_once: int) -> np.ndarray:
        """Ids of one long text, cut at white space so that about ``at_once`` bytes are in work."""
        if not self.by_word:
            return self.encode_array(pa.array([text.decode("utf-8")], pa.string()))[0]
        parts, start, blank = [], 0, re.compile(rb"[ \t-\r]")
        while start < len(text):
            m = blank.search(text, start + at_once)
            stop = m.start() if m else len(text)
            parts.append(self.encode_array(pa.array([text[start:stop].decode("utf-8")], pa.string()))[0])
            start = stop
        return np.concatenate(parts)


class Ranges:
    """Ranges of the id (a null counts as the smallest), from ascending cuts.

    A range ends before its cut. A cut that repeats is an id with more rows
    than a range holds: its rows are dealt over the ranges between the equal
    cuts and the one after, by a hash of the row's ids, its task and its number
    among the equal rows of that task. So the same rows make the same deal when
    a task is repeated, in whatever order they come.
    """

    def __init__(self, cuts: np.ndarray):
        self.cuts = cuts
        self.hot = np.unique(cuts[1:][cuts[1:] == cuts[:-1]])

    def of(self, keys: np.ndarray, real: np.ndarray, digests, task: int, seen: Counter) -> np.ndarray:
        """keys: ids, nulls as the smallest integer; real: not null; digests(i): hash of row i's ids."""
        found = np.searchsorted(self.cuts, keys, side="right")
        for i in np.flatnonzero(np.isin(keys, self.hot)):
            if keys[i] == INT64_MIN and real[i]:
                continue  # stays behind all nulls
            first = int(np.searchsorted(self.cuts, keys[i], side="left")) + int(keys[i] != INT64_MIN)
            h = digests(i)
            nth = seen[int(keys[i]), h]
            seen[int(keys[i]), h] += 1
            found[i] = first + xxhash.xxh64_intdigest(f"{task}:{nth}", h) % (int(found[i]) - first + 1)
        return found


def id_cuts(docs: DataFrame, id_col: str, text_col: str, range_chars: int) -> np.ndarray:
    """Ascending cuts of the ids, from a sample of about 200 ids for each range."""
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(INT64_MIN)).alias("k"),
                      F.coalesce(F.length(text_col), F.lit(0)).alias("chars"))
    chars, rows = ids.agg(F.sum("chars"), F.count("*")).first()
    # beyond 4,096 ranges they grow first, up to 64 times, so that the cuts stay few
    size = min(max(range_chars, (chars or 0) // 4096), 64 * range_chars)
    ranges = -(-(chars or 0) // size)
    if ranges < 2:
        return np.zeros(0, dtype=np.int64)
    return np.array(sorted(sampled_cuts(ids.select("k"), rows, ranges, each=200)), dtype=np.int64)


@lru_cache(maxsize=1)
def _kept_encoder(vocabulary: str) -> WordEncoder:
    """The encoder of a Python worker, with the pieces that its earlier tasks learned."""
    return WordEncoder(vocabulary)


def encoded(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, cuts: np.ndarray,
            batch_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, range, ids): ids with the end id, compressed, for each document."""
    sent = docs.sparkSession.sparkContext.broadcast(cuts)  # one number per range

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, z = _kept_encoder(vocabulary), zstandard.ZstdCompressor(level=1)
        ranges, task, seen = Ranges(sent.value), TaskContext.get().partitionId(), Counter()
        for b in batches:
            for i, j in text_slices(b["text"], batch_bytes):
                part = b.slice(i, j - i)
                if j == i + 1 and part["text"].nbytes > 2 * batch_bytes:
                    ids = enc.encode_long(part["text"][0].as_buffer().to_pybytes(), batch_bytes)
                    lens = np.array([len(ids)])
                else:
                    ids, lens = enc.encode_array(part["text"])
                wide = len(ids) and int(ids.max()) >= 1 << 16
                ends = np.cumsum(lens)
                whole = np.insert(ids.astype("<u4" if wide else "<u2"), ends, END_ID)
                ends = ends + np.arange(1, len(ends) + 1)
                cut = [z.compress(whole[e - n - 1:e].tobytes()) for e, n in zip(ends.tolist(), lens.tolist())]
                cut = [b"\0" + c for c in cut] if wide else cut
                keys = pc.fill_null(part["doc_id"], INT64_MIN).to_numpy()
                rng = ranges.of(keys, part["doc_id"].is_valid().to_numpy(zero_copy_only=False),
                                lambda k: xxhash.xxh64_intdigest(cut[k]), task, seen)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(rng, pa.int32()), pa.array(cut, pa.binary())],
                    names=["doc_id", "range", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, range int, ids binary")


def write_token_files(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id",
                      text_col: str = "text", file_ids: int = 1 << 19, range_chars: int = 4 << 20,
                      block: int = 4096, percentile: float = 0.95) -> None:
    """Write the ids of all documents to ``path``: one row per file, with the number
    of ids before it in its range (``first``).

    Files ordered by (range, file) hold the documents by ascending id, nulls
    first; rows of one id go in any order. Null and empty texts have the end id
    alone. A file ends with the document that takes it past ``file_ids`` ids.
    Ranges hold about ``range_chars`` characters, or 1/4096 of all where that
    is more, up to 64 times as many. ids are integers of any 64 bits.
    vocabulary: path of a tokenizer file that executors can read. An empty
    table writes no files. Other columns are not read.
    """
    cuts = id_cuts(docs, id_col, text_col, range_chars)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        own, file, first, docs_, arrays, size = None, 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            lens = np.array([len(a) for a in arrays])
            data = encode_file(docs_, lens, np.concatenate(arrays), block, percentile)
            return pa.RecordBatch.from_arrays(
                [pa.array([own], pa.int32()), pa.array([file], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([len(docs_)], pa.int64()), pa.array([int(lens.sum())], pa.int64()),
                 pa.array([data], pa.binary())], names=[c.split()[0] for c in _FILES.split(", ")])

        for b in batches:
            for rng, doc, x in zip(*(b[c].to_pylist() for c in ("range", "doc_id", "ids"))):
                if docs_ and (rng != own or size >= file_ids):
                    yield flush()
                    file, first, docs_, arrays, size = file + 1, first + size, [], [], 0
                if rng != own:
                    own, file, first = rng, 0, 0
                a = (np.frombuffer(z.decompress(x[1:]), dtype="<u4") if x[:1] == b"\0"
                     else np.frombuffer(z.decompress(x), dtype="<u2"))
                docs_.append(doc)
                arrays.append(a)
                size += len(a)
        if docs_:
            yield flush()

    (encoded(docs, vocabulary, id_col, text_col, cuts)
     .repartitionById(len(cuts) + 1, "range")
     .sortWithinPartitions("range", "doc_id")
     .mapInArrow(assemble, _FILES)
     .write.option("compression", "none").parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), ids."""
    files = spark.read.schema(_FILES).parquet(path)
    # one short row per range
    sizes = files.groupBy("range").agg(F.sum("n_ids").alias("n"))
    starts = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for base, data in zip(b["base"].to_pylist(), b["data"].to_pylist()):
                f = File(data)
                ids, at = f.ids(), np.cumsum(f.lengths) - f.lengths
                for i in range(0, len(at), 256):
                    rows = range(i, min(i + 256, len(at)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f.doc_ids[k] for k in rows], pa.int64()),
                        pa.array([int(base + at[k]) for k in rows], pa.int64()),
                        pa.array([ids[at[k]:at[k] + f.lengths[k]].astype("<u4").tobytes()
                                  for k in rows], pa.binary())], names=["doc_id", "start", "ids"])

    return (files.join(F.broadcast(starts), "range")
            .select((F.col("before") + F.col("first")).alias("base"), "data")
            .mapInArrow(run, "doc_id long, start long, ids binary"))


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of documents read back (ids: 32-bit, little-endian)."""
    return tokens.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                         F.crc32("ids").alias("ids_crc32"))


def token_file_path(spark: SparkSession) -> str:
    return scratch_path(spark, f"token_files_{uuid.uuid4().hex}")
