"""Repeated byte strings by a sorted, sparse suffix array.

A window is a string of ``length`` bytes. A byte is removed if it lies in a
window that also starts at another place, in any document.

Suffixes. Sorting the suffix at every byte would move each byte hundreds of
times. A window is known instead by its anchor: the place in it with the
smallest hashed gram (leftmost of equals). That choice depends on the window's
bytes alone, so equal windows have their anchors at the same offset, and the
suffixes at anchors are enough. The windows of one anchor start in a run; the
bytes they cover are its segment.

Classes. Documents are packed into blocks. Each block sends the hashes of its
distinct segments, and of its distinct grams with one segment of each, to hash
ranges (shards) that answer which segments occur again and which grams occur
in unlike segments. Equal segments are one class: all their windows repeat.
A gram with one segment only can match nothing else. What is left, one of each
class and every single segment whose gram has unlike ones, is sorted.

Sorting. A sample of these suffixes gives splitters, which deal all suffixes
to buckets by their leading tokens (bytes). Each bucket sorts its suffixes by
multikey quicksort, 8 bytes a token, and the reversed bytes before the anchors
in the same way. With both orders and the common prefixes of neighbours, a
window of offset d has the class (suffixes alike for ``length - d`` bytes,
what stands before alike for d bytes); a class of two or more windows repeats.
Suffixes whose gram is also that of a splitter may go on in the next bucket:
their distinct windows are compared across the boundaries by a grouped count.
So a gram with any number of suffixes is cut into buckets of bounded size.

No match is lost and none made up, except where 96 bits of a segment's hash
or 128 bits of a window's hash agree by chance.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.blobs import pack, pack_sorted, unpack, unpack_sorted
from cellfold.llm.common import sampled_cuts, text_slices
from cellfold.session import scratch_path

UNIQUE, FIRST, AGAIN = 0, 1, 2  # a segment's state
_BLOCKS = "block long, ids array<long>, lens binary, n_bytes long, data binary"
_SUFFIXES = "block long, lo long, ahead int, text binary"
_SUFFIX_SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("lo", pa.int64()),
                            ("ahead", pa.int32()), ("text", pa.binary())])
_WINDOWS = "window binary, block long, first long, last long, n long"
_PLACE = 20  # low bits of a gram's rank hold its place in the piece, so that ties go left


def gram_size(length: int) -> int:
    return max(1, min(24, length // 4))


def anchors_of(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window), ascending, of all windows of one text."""
    parts = []
    step = (1 << _PLACE) - length - 8
    for at in range(0, len(text) - length + 1, step):
        a, lo, hi = _anchors(text[at:at + step + length - 1], length)
        parts.append(np.stack([a, lo, hi]) + at)
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    a, lo, hi = np.concatenate(parts, axis=1)
    start = np.flatnonzero(np.diff(a, prepend=-1))  # a piece may begin inside an anchor's run
    return a[start], lo[start], np.append(lo[start][1:], hi[-1] + 1) - 1


def _anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = gram_size(length)
    n, grams = len(text) - length + 1, len(text) - k + 1
    rank, padded = np.empty(grams, np.uint64), text + bytes(8)
    for i in range(min(8, grams)):
        own = rank[i::8]
        own[:] = np.frombuffer(padded, "<u8", (len(padded) - i) // 8, i)[:len(own)]
    if k < 8:
        rank &= np.uint64((1 << 8 * k) - 1)
    rank *= np.uint64(0x9E3779B97F4A7C15)
    rank ^= rank >> np.uint64(29)
    rank *= np.uint64(0xC2B2AE3D27D4EB4F)
    low = np.uint64((1 << _PLACE) - 1)
    rank &= ~low
    rank |= np.arange(grams, dtype=np.uint64)
    span, reach = length - k + 1, 1  # least rank of each run of ``span`` grams
    while 2 * reach <= span:
        rank = np.minimum(rank[:-reach], rank[reach:])
        reach *= 2
    if span > reach:
        rank = np.minimum(rank[:reach - span], rank[span - reach:])
    place = (rank[:n] & low).astype(np.int64)
    start = np.flatnonzero(np.diff(place, prepend=-1))
    return place[start], start, np.append(start[1:], n) - 1


class Block:
    """Segments of a block of texts, in block coordinates, with their hashes."""

    def __init__(self, lens: np.ndarray, data: bytes, length: int):
        self.data, found, at = data, [], 0
        for n in lens.tolist():
            if n >= length:
                found.append(np.stack(anchors_of(data[at:at + n], length)) + at)
            at += n
        self.anchor, self.lo, self.hi = (np.concatenate(found, axis=1) if found
                                         else np.zeros((3, 0), np.int64))
        view, k = memoryview(data), gram_size(length)
        self.gram = np.array([xxhash.xxh3_64_intdigest(view[a:a + k]) for a in self.anchor.tolist()], np.uint64)
        both = [xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(
            self.lo.tolist(), (self.hi + length).tolist())]
        both = np.frombuffer(b"".join(both), ">u8").astype(np.uint64).reshape(-1, 2)
        self.seg, self.more = both[:, 0], both[:, 1] & np.uint64(0xFFFFFFFF)
        # distinct segments and, of each gram, the least and the greatest segment
        self.seg_keys, first, self.seg_of, self.seg_n = np.unique(
            self.seg, return_index=True, return_inverse=True, return_counts=True)
        self.seg_more = self.more[first]
        order = np.lexsort((self.seg, self.gram))
        self.gram_keys, start = np.unique(self.gram[order], return_index=True)
        self.gram_of = np.searchsorted(self.gram_keys, self.gram)
        self.gram_low = self.seg[order][start]
        last = np.append(start[1:], len(order))[:len(start)] - 1
        self.gram_mixed = self.gram_low != self.seg[order][last]


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the shards' parts of sorted keys begin and end; shards own equal ranges of hashes."""
    shard = ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1))


def make_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq, z = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        for b in batches:
            for i, j in text_slices(b["text"], block_bytes):
                texts = [t or b"" for t in b["text"].slice(i, j - i).cast(pa.binary()).to_pylist()]
                lens = np.fromiter(map(len, texts), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 32 | seq], pa.int64()),
                     pa.array([b["doc_id"].slice(i, j - i).to_pylist()], pa.list_(pa.int64())),
                     pa.array([pack(lens)], pa.binary()), pa.array([int(lens.sum())], pa.int64()),
                     pa.array([z.compress(b"".join(texts))], pa.binary())],
                    names=[c.split()[0] for c in _BLOCKS.split(", ")])
                seq += 1

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, _BLOCKS)


def _open(lens: bytes, data: bytes) -> tuple[np.ndarray, bytes]:
    return unpack(lens).astype(np.int64), zstandard.ZstdDecompressor().decompress(data)


def classes(blocks: DataFrame, length: int, shards: int) -> DataFrame:
    """(block, shard, states, mixed): of a block's distinct segments and grams, in key
    order, those of one shard: the segments' states, and whether a gram has unlike segments."""
    names = ["block", "shard", "seg", "more", "twice", "gram", "low", "mixed"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, lens, data in zip(*(b[c].to_pylist() for c in ("block", "lens", "data"))):
                k = Block(*_open(lens, data), length)
                s, g, rows = _cuts(k.seg_keys, shards), _cuts(k.gram_keys, shards), []
                for i in range(shards):
                    a, z, c, d = s[i], s[i + 1], g[i], g[i + 1]
                    if z > a or d > c:
                        rows.append((block, i, pack_sorted(k.seg_keys[a:z]),
                                     k.seg_more[a:z].astype("<u4").tobytes(),
                                     np.packbits(k.seg_n[a:z] > 1).tobytes(), pack_sorted(k.gram_keys[c:d]),
                                     k.gram_low[c:d].astype("<u8").tobytes(),
                                     np.packbits(k.gram_mixed[c:d]).tobytes()))
                if rows:
                    kinds = [pa.int64(), pa.int32()] + 6 * [pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(col, kind) for col, kind in zip(zip(*rows), kinds)], names=names)

    def bits(blobs: list[bytes], sizes: list[int]) -> np.ndarray:
        return np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n)
                               for x, n in zip(blobs, sizes)]).astype(bool)

    def answer(t: pa.Table) -> pa.Table:
        col = {c: t[c].to_pylist() for c in names}
        seg, gram = ([unpack_sorted(x) for x in col[c]] for c in ("seg", "gram"))
        n_seg, n_gram = [len(x) for x in seg], [len(x) for x in gram]
        seg, gram = np.concatenate(seg), np.concatenate(gram)
        more = np.concatenate([np.frombuffer(x, "<u4") for x in col["more"]])
        block = np.repeat(np.array(col["block"]), n_seg)
        # a block asks once for a segment; the least block of a class sends it on
        order = np.lexsort((block, more, seg))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(seg[order]) != 0) | (np.diff(more[order]) != 0)
        group = np.cumsum(new) - 1
        times = np.bincount(group, weights=1 + bits(col["twice"], n_seg)[order], minlength=1)
        states = np.empty(len(order), np.uint8)
        states[order] = np.where(times[group] < 2, UNIQUE, np.where(new, FIRST, AGAIN)) if len(order) else 0
        low = np.concatenate([np.frombuffer(x, "<u8") for x in col["low"]])
        order = np.argsort(gram, kind="stable")
        start = np.flatnonzero(np.diff(gram[order], prepend=~gram[order[:1]]) != 0)
        unlike = np.zeros(len(order), bool)
        if len(order):
            own = low[order]
            any_mixed = np.maximum.reduceat(bits(col["mixed"], n_gram)[order], start)
            many = np.minimum.reduceat(own, start) != np.maximum.reduceat(own, start)
            unlike[order] = np.repeat(any_mixed | many, np.diff(np.append(start, len(order))))
        s, g = np.cumsum([0, *n_seg]), np.cumsum([0, *n_gram])
        z = zstandard.ZstdCompressor(level=1)
        return pa.table({
            "block": t["block"], "shard": t["shard"],
            "states": pa.array([z.compress(states[i:j].tobytes()) for i, j in zip(s, s[1:])], pa.binary()),
            "mixed": pa.array([np.packbits(unlike[i:j]).tobytes() for i, j in zip(g, g[1:])], pa.binary())})

    asked = blocks.mapInArrow(ask, "block long, shard int, seg binary, more binary, twice binary, "
                                   "gram binary, low binary, mixed binary")
    return asked.groupBy("shard").applyInArrow(
        answer, "block long, shard int, states binary, mixed binary")


def suffixes(blocks: DataFrame, answers: DataFrame, length: int, shards: int) -> DataFrame:
    """(block, lo, ahead, text): the segments that must be sorted, with ``ahead`` bytes
    before the anchor; and for each block one row whose ``text`` holds the runs of
    windows (first, last) that repeat as whole segments, with ``lo`` null."""
    def run(t: pa.Table, a: pa.Table) -> pa.Table:
        block, lo, ahead, text = [], [], [], []
        for own, lens, data in zip(*(t[c].to_pylist() for c in ("block", "lens", "data"))):
            k, z = Block(*_open(lens, data), length), zstandard.ZstdDecompressor()
            states, mixed = np.zeros(len(k.seg_keys), np.uint8), np.zeros(len(k.gram_keys), bool)
            s, g = _cuts(k.seg_keys, shards), _cuts(k.gram_keys, shards)
            for i, x, y in zip(*(a[c].to_pylist() for c in ("shard", "states", "mixed"))):
                states[s[i]:s[i + 1]] = np.frombuffer(z.decompress(x), np.uint8)
                mixed[g[i]:g[i + 1]] = np.unpackbits(np.frombuffer(y, np.uint8), count=g[i + 1] - g[i])
            state = states[k.seg_of]
            # in a block, the first place of a class stands for it
            first = np.zeros(len(state), bool)
            first[np.unique(k.seg_of, return_index=True)[1]] = True
            send = np.flatnonzero(mixed[k.gram_of] & first & (state != AGAIN))
            full = np.flatnonzero(state != UNIQUE)
            block += [own] * (len(send) + 1)
            lo += [None, *k.lo[send].tolist()]
            ahead += [0, *(k.anchor - k.lo)[send].tolist()]
            text.append(pack_runs(k.lo[full], k.hi[full]))
            text += [k.data[i:j] for i, j in zip(k.lo[send].tolist(), (k.hi[send] + length).tolist())]
        return pa.table({"block": pa.array(block, pa.int64()), "lo": pa.array(lo, pa.int64()),
                         "ahead": pa.array(ahead, pa.int32()), "text": pa.array(text, pa.binary())})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, _SUFFIXES)


def pack_runs(lo: np.ndarray, hi: np.ndarray) -> bytes:
    """Ascending runs of windows, those that follow each other as one."""
    if not len(lo):
        return b""
    new = np.concatenate([[True], lo[1:] > hi[:-1] + 1])
    last = np.append(np.flatnonzero(new)[1:], len(lo)) - 1
    return np.stack([lo[new], hi[last]], axis=1).astype("<i8").tobytes()


def suffix_key(text: bytes, ahead: int, length: int) -> bytes:
    """Order of suffixes: from the anchor on, then backwards from it."""
    return text[ahead:ahead + length].ljust(length, b"\0") + text[:ahead][::-1]


def multikey_sort(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): strings (rows of bytes) in order, and the bytes that each has in
    common with the one before it.

    Multikey quicksort with tokens of 8 bytes: what ties so far is sorted by
    its next token, split where that differs, and only ties go on.
    """
    n, size = strings.shape
    wide = -(-size // 8) * 8
    tokens = np.zeros((n, wide), np.uint8)
    tokens[:, :size] = strings
    tokens = tokens.view(">u8").astype(np.uint64)
    order, common = np.arange(n), np.zeros(n, np.int64)
    tied = np.arange(n)  # places in the order whose string ties with a neighbour
    part = np.zeros(n, np.int64)  # number of the tie that a place belongs to
    for depth in range(wide // 8):
        if not len(tied):
            break
        own = tokens[order[tied], depth]
        by = np.lexsort((own, part[tied]))
        order[tied], own = order[tied][by], own[by]
        # the first token in which neighbours of one tie differ ends what they have in common
        same_part = np.concatenate([[False], (np.diff(part[tied]) == 0)])
        gap = own ^ np.concatenate([own[:1], own[:-1]])
        alike = np.zeros(len(gap), np.int64)
        for i in range(8):
            alike += (gap >> np.uint64(56 - 8 * i)) == 0
        common[tied[same_part]] = np.minimum(8 * depth + alike[same_part], size)
        new = ~same_part | (gap != 0)
        part[tied] = np.cumsum(new) + n * (depth + 1)
        again = ~new
        keep = again | np.append(again[1:], False)
        tied = tied[keep]
    return order, common


def repeated_windows(texts: list[bytes], ahead: np.ndarray, length: int):
    """For distinct segments: dup[row, d], whether the window d bytes before the row's
    anchor equals one of another row, and has[row, d], whether the row has that window."""
    n, before = len(texts), length - gram_size(length)
    right, left = np.zeros((n, length), np.uint8), np.zeros((n, before), np.uint8)
    for i, (t, a) in enumerate(zip(texts, ahead.tolist())):
        b = np.frombuffer(t, np.uint8)
        right[i, :min(length, len(b) - a)] = b[a:a + length]
        left[i, :a] = b[:a][::-1]
    size = np.fromiter(map(len, texts), np.int64, n)
    least, most = ahead - (size - length), ahead  # offsets of the row's windows
    (r_order, r_common), (l_order, l_common) = multikey_sort(right), multikey_sort(left)
    dup = np.zeros((n, before + 1), bool)
    offsets = np.arange(before + 1)
    has = (least[:, None] <= offsets) & (offsets <= most[:, None])
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in np.flatnonzero(has.sum(axis=0) > 1):
        r_class[r_order] = np.cumsum(r_common < length - d)
        l_class[l_order] = np.cumsum(l_common < d)
        rows = np.flatnonzero(has[:, d])
        key = r_class[rows] << 32 | l_class[rows]
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        dup[rows, d] = times[inverse] > 1
    return dup, has


def sort_buckets(found: DataFrame, length: int, bucket_rows: int, path: str) -> DataFrame:
    """Runs of repeated windows (block, first, last) among the suffixes to be sorted.

    What a bucket finds is written to ``path``, so the sort is not repeated.
    """
    spark, k = found.sparkSession, gram_size(length)
    rows = found.filter("lo is not null").select("block", "lo", "ahead", "text")
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))

    def keys_of(b: pa.RecordBatch) -> list[bytes]:
        return [suffix_key(t, a, length) for t, a in zip(b["text"].to_pylist(), b["ahead"].to_pylist())]

    def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(keys_of(b), pa.binary())], names=["key"])

    splitters = sorted(sampled_cuts(rows, total, buckets, lambda x: x.mapInArrow(with_keys, "key binary")))
    sent = spark.sparkContext.broadcast(splitters)  # one key per bucket

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            to = [bisect_right(sent.value, key) for key in keys_of(b)]
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *b.columns],
                                             names=["bucket", *b.schema.names])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches), _SUFFIX_SCHEMA)  # one bucket, about bucket_rows
        if not held.num_rows:
            return
        block, lo, ahead = (held[c].to_numpy().astype(np.int64) for c in ("block", "lo", "ahead"))
        texts, bucket = held["text"].to_pylist(), held["bucket"][0].as_py()
        dup, has = repeated_windows(texts, ahead, length)
        top = lo + ahead  # the anchor's place
        edge = np.diff(np.pad(dup, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        yield _window_rows(None, block[row], top[row] - last, top[row] - first, np.zeros(len(row), np.int64))
        # suffixes that may go on in a neighbouring bucket: one row per distinct window
        ends = {s[:k] for s in sent.value[max(0, bucket - 1):bucket + 1]}
        on = np.array([i for i, (t, a) in enumerate(zip(texts, ahead.tolist())) if t[a:a + k] in ends], np.int64)
        at, d = np.nonzero(has[on])
        at = on[at]
        one = {xxhash.xxh3_128_digest(texts[i][a - x:a - x + length]): j for j, (i, a, x) in enumerate(
            zip(at.tolist(), ahead[at].tolist(), d.tolist()))}
        pick = np.fromiter(one.values(), np.int64, len(one))
        place = top[at[pick]] - d[pick]
        yield _window_rows(list(one), block[at[pick]], place, place, np.where(dup[at[pick], d[pick]], 2, 1))

    (rows.mapInArrow(deal, "bucket int, block long, lo long, ahead int, text binary")
     .repartitionById(buckets, "bucket").mapInArrow(sort, _WINDOWS).write.parquet(path))
    got = spark.read.schema(_WINDOWS).parquet(path)
    compare = got.filter("window is not null")
    again = compare.groupBy("window").agg(F.sum("n").alias("times")).filter("times > 1").select("window")
    across = compare.filter("n = 1").join(again, "window", "left_semi")
    return (got.filter("window is null").select("block", "first", "last")
            .unionByName(across.select("block", "first", "last")))


def _window_rows(windows: list[bytes] | None, *longs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(longs[0]), pa.binary()) if windows is None else pa.array(windows, pa.binary()),
         *[pa.array(x, pa.int64()) for x in longs]], names=["window", "block", "first", "last", "n"])


def cut_out(blocks: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Documents without the bytes of the runs (block, first, last, whole) of windows."""
    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("doc_id", "n_bytes", "spans", "kept")}
        packed = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in r["whole"].to_pylist() if x]
        single = r.filter(pc.is_valid(r["first"]))
        packed.append(np.stack([single["first"].to_numpy(), single["last"].to_numpy()], axis=1))
        found = np.concatenate(packed).astype(np.int64)
        found = found[np.argsort(found[:, 0], kind="stable")]
        for ids, lens, data in zip(*(t[c].to_pylist() for c in ("ids", "lens", "data"))):
            lens, data = _open(lens, data)
            ends = np.cumsum(lens)
            # one place between documents, so that spans of two never touch
            doc = np.searchsorted(ends, found[:, 0], side="right")
            first, stop = found[:, 0] + doc, found[:, 1] + length + doc
            reach = np.maximum.accumulate(stop)
            new = np.ones(len(first), bool)
            new[1:] = first[1:] > reach[:-1]
            begin = np.flatnonzero(new)
            start, stop = first[begin] - doc[begin], np.append(reach[begin[1:] - 1], reach[-1:]) - doc[begin]
            cut = np.searchsorted(doc[begin], np.arange(len(lens) + 1))
            for i, (own, n, end) in enumerate(zip(ids, lens.tolist(), ends.tolist())):
                spans = list(zip(start[cut[i]:cut[i + 1]].tolist(), stop[cut[i]:cut[i + 1]].tolist()))
                at, kept = end - n, []
                for x, y in spans:
                    kept.append(data[at:x])
                    at = y
                kept.append(data[at:end])
                out["doc_id"].append(own)
                out["n_bytes"].append(n)
                out["spans"].append([{"start": x - end + n, "stop": y - end + n} for x, y in spans])
                out["kept"].append(b"".join(kept))
        return pa.table([pa.array(out["doc_id"], pa.int64()), pa.array(out["n_bytes"], pa.int64()),
                         pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                         pa.array(out["kept"], pa.binary())], names=list(out))

    return blocks.groupBy("block").cogroup(runs.groupBy("block")).applyInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   block_bytes: int = 4 << 20, shard_bytes: int = 16 << 20,
                   bucket_rows: int = 1 << 14) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (start, stop: bytes removed, stop
    exclusive, maximal), kept (the bytes that are left, which may cut a character).

    Texts count as UTF-8 bytes, null as empty. Every place counts, also in
    repeated rows and of the same document; strings never cross documents and
    are judged on the input. Ids are integers of up to 64 bits; null and
    repeated ids keep their rows. An empty table gives no rows; other columns
    are not read. A text must fit in one task.

    block_bytes: text of a block, which grows with the square root of the input
    beyond 4 GB, up to 64 times; shard_bytes: text whose hashes meet in one
    shard, more where a block would send a shard under 64 hashes;
    bucket_rows: suffixes sorted at once.
    """
    if length < 2:
        raise ValueError("length must be 2 at least")
    spark = docs.sparkSession
    base = scratch_path(spark, f"suffix_{uuid.uuid4().hex}")
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    block_bytes = int(block_bytes * min(64.0, max(1.0, (total / (1 << 32)) ** 0.5)))
    shards = max(1, min(-(-total // shard_bytes), block_bytes // (64 * 64)))
    make_blocks(docs, id_col, text_col, block_bytes).write.option("compression", "none") \
        .parquet(f"{base}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{base}/blocks")
    suffixes(blocks, classes(blocks, length, shards), length, shards) \
        .write.option("compression", "zstd").parquet(f"{base}/suffixes")
    found = spark.read.schema(_SUFFIXES).parquet(f"{base}/suffixes")
    runs = sort_buckets(found, length, bucket_rows, f"{base}/windows")
    whole = found.filter("lo is null").select("block", F.lit(None).cast("long").alias("first"),
                                              F.lit(None).cast("long").alias("last"), F.col("text").alias("whole"))
    return cut_out(blocks, runs.withColumn("whole", F.lit(None).cast("binary")).unionByName(whole), length)
