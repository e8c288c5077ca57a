"""SimHash near-duplicate groups by pivot distance tables.

A document's fingerprint is the bitwise majority over the XXH64 hashes of its
word shingles. Fingerprints link at ``max_bits`` or fewer differing bits; the
connected components of the links are the groups.

Finding the links. Every distinct fingerprint gets a row of Hamming distances
to fixed reference fingerprints (pivots): the zero pivot, and for each of
``blocks`` bit blocks several pivots whose set bits lie in that block only.
By the triangle inequality two linked fingerprints differ by at most
``max_bits`` in every coordinate. The distance to a block's pivot minus the
distance to the zero pivot depends on the bits of that block alone, so two
linked fingerprints agree *exactly* on these differences in all blocks but
``max_bits`` at most: every choice of ``blocks - max_bits`` blocks gives one
join key made of their coordinates. Pairs that meet in a key are discarded by
the maximum coordinate difference over the whole table, and the survivors are
verified on the fingerprints themselves. No pair is lost.

A key shared by more than ``bucket`` distinct fingerprints is not expanded
into pairs. Its members are linked exactly through midpoints instead (for
``max_bits`` = 2): two fingerprints are within two bits if and only if some
64-bit value is within one bit of both. Each member lists its 65 such values,
and members that list the same value are linked to the smallest of them, so
the work there is linear in the members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cellfold.llm.common import ascii_words, checkpoint, id_text, split_joined, with_long_id
from cellfold.llm.graph import components

CHUNK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of one text (whole text; null or no words: 0)."""
    words = ascii_words(text)
    if not words:
        return 0
    joined, starts, ends = split_joined(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    first, last = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(first), CHUNK):
        h = np.array([digest(joined[a:b], 42)
                      for a, b in zip(first[i:i + CHUNK], last[i:i + CHUNK])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, **longs: Column) -> DataFrame:
    """(doc_id, fp) with fp the fingerprint as a signed long; one row per input row.
    Further columns, longs that are never null, are passed on by name."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp.view(np.int64),
                                **{c: b[c] for c in names}})

    names = list(longs)
    return with_long_id(
        docs.select(id_text(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                    *[c.alias(n) for n, c in longs.items()])
        .mapInPandas(run, ", ".join(["doc_id string", "fp long", *[f"{c} long" for c in names]])))


def pivot_masks(blocks: int = 5, per_block: int = 6, seed: int = 7) -> list[list[int]]:
    """For each bit block, the pivots whose set bits are half of that block."""
    rng = np.random.default_rng(seed)
    edges = [64 * b // blocks for b in range(blocks + 1)]
    out = []
    for lo, hi in zip(edges, edges[1:]):
        rows = [rng.permutation(np.arange(lo, hi))[: (hi - lo) // 2] for _ in range(per_block)]
        out.append([sum(1 << int(b) for b in r) for r in rows])
    return out


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def pivot_table(fps: DataFrame, masks: list[list[int]]) -> DataFrame:
    """Adds ``dist``: Hamming distances to the zero pivot, then to every block's pivots."""
    pivots = ", ".join(f"{_signed(p)}L" if _signed(p) > -1 << 63 else f"bigint('{_signed(p)}')"
                       for p in [0] + [m for block in masks for m in block])
    return fps.withColumn("dist", F.expr(
        f"transform(array({pivots}), p -> cast(bit_count(fp ^ p) as tinyint))"))


def links(fps: DataFrame, max_bits: int = 2, blocks: int = 5, per_block: int = 6,
          bucket: int = 64) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are those
    of all pairs at ``max_bits`` or fewer differing bits (1 or 2)."""
    if not 1 <= max_bits <= 2 or blocks <= max_bits:
        raise ValueError("max_bits must be 1 or 2 and below blocks")
    masks = pivot_masks(blocks, per_block)
    part = lambda b: f"slice(rel, {1 + b * per_block}, {per_block})"
    keys = ", ".join(f"xxhash64({g}, {', '.join(map(part, chosen))})" for g, chosen in
                     enumerate(combinations(range(blocks), blocks - max_bits)))
    keyed = (pivot_table(fps.select("fp"), masks)
             .withColumn("rel", F.expr(f"transform(slice(dist, 2, {blocks * per_block}), "
                                       "d -> cast(d - dist[0] as tinyint))"))
             .select("fp", "dist", F.explode(F.expr(f"array({keys})")).alias("key")))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = checkpoint(keyed.join(sizes, "key"))
    left = met.filter(F.col("n") <= bucket)
    right = left.select("key", F.col("fp").alias("fp_b"), F.col("dist").alias("dist_b"))
    apart = F.expr("array_max(zip_with(dist, dist_b, (x, y) -> abs(x - y)))")
    pairs = (left.join(right, "key").filter(F.col("fp") < F.col("fp_b"))
             .filter(apart <= max_bits)
             .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_b"))) <= max_bits)
             .select(F.col("fp").alias("a"), F.col("fp_b").alias("b")))
    crowded = met.filter(F.col("n") > bucket).select("fp").distinct()
    flips = "transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i))"
    if max_bits == 2:
        listed = crowded.select("fp", F.explode(F.expr(f"concat(array(fp), {flips})")).alias("mid"))
        first = (listed.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
                 .filter("n > 1").drop("n"))
        through = (listed.join(first, "mid").filter("a < fp")
                   .select("a", F.col("fp").alias("b")))
    else:  # one bit: every neighbour is itself a value to look up
        through = (crowded.select(F.col("fp").alias("b"), F.explode(F.expr(flips)).alias("a"))
                   .join(crowded.select(F.col("fp").alias("a")), "a").filter("a < b")
                   .select("a", "b"))
    return pairs.unionByName(through).distinct()


def _rooted(distinct: DataFrame, max_bits: int, **search) -> DataFrame:
    """Adds ``root``, never null, to distinct fingerprints: the smallest of the component."""
    root = components(checkpoint(links(distinct, max_bits, **search)))
    return (distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("root", F.coalesce("root", "fp")))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, max_bits: int = 2, **search) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links, the row's own
    included. Null or empty text: fingerprint zero, linked like any other.
    Repeated rows are copies and get the same component. A null doc_id keeps
    its row; a component whose ids are all null has a null component_id. Ids
    are integers of up to 64 bits. An empty table gives no rows; other columns
    are not read.
    """
    fp = checkpoint(fingerprints(docs, id_col, text_col, shingle))
    distinct = fp.groupBy("fp").agg(F.min("doc_id").alias("low"))
    merged = _rooted(distinct, max_bits, **search)
    lowest = merged.groupBy("root").agg(F.min("low").alias("component_id"))
    label = merged.join(lowest, "root").select("fp", "component_id")
    return fp.join(label, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _hashable(name: str, kind: DataType) -> Column:
    """The column in a form that has a hash: whatever holds a map as JSON text."""
    return F.to_json(F.struct(name)) if "map<" in kind.simpleString() else F.col(name)


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, **search) -> DataFrame:
    """One row of each component, with all columns: that of the smallest id (null
    ids last), and among rows of that id the one with the smallest row hash.

    Ids (integers, null allowed) need not be unique: a row is known by its id
    and two hashes of all its columns. Of rows equal in every column, one
    stays. Columns may have any names and types; two rows that differ only in
    the order of a map's entries are not equal.
    """
    names = docs.columns
    docs = docs.toDF(*[f"c{k}" for k in range(len(names))])  # names with dots, or like ours
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    cells = [x for f in docs.schema for x in (F.col(f.name).isNull(), _hashable(f.name, f.dataType))]
    row_id = F.col(id_col).cast("long")
    hashes = {"h1": F.xxhash64(*cells), "h2": F.xxhash64(F.lit(1), *cells)}
    fp = checkpoint(fingerprints(docs, id_col, text_col, shingle, **hashes))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2", "n"))
    distinct = checkpoint(fp.groupBy("fp", "doc_id", "h1", "h2").agg(F.count("*").alias("n"))
                          .groupBy("fp").agg(first.alias("low")))
    lead = checkpoint(_rooted(distinct, max_bits, **search).groupBy("root")
                      .agg(F.min("low").alias("low"))
                      .select(F.col("low.doc_id").alias("lead_id"), F.col("low.h1").alias("lead_h1"),
                              F.col("low.h2").alias("lead_h2"), F.col("low.n").alias("n")))

    def rows(keys: DataFrame) -> DataFrame:
        met = (row_id.eqNullSafe(F.col("lead_id")) & (hashes["h1"] == F.col("lead_h1"))
               & (hashes["h2"] == F.col("lead_h2")))
        return docs.join(keys.drop("n"), met, "left_semi")

    # equal rows are one: their columns, maps as entries, are grouped and one of each is taken
    many = rows(lead.filter("n > 1")).groupBy(row_id.alias("k0"), hashes["h1"].alias("k1"), hashes["h2"].alias("k2"))
    one = many.agg(*[F.first(c).alias(c) for c in docs.columns]).drop("k0", "k1", "k2")
    return rows(lead.filter("n = 1")).unionByName(one).toDF(*names)
