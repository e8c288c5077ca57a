"""A Merkle manifest of a dataset with one proof per row, by time-forward processing.

Rows are leaves. The leaves of a group (a source), by ascending id, are hashed
in runs of ``fan`` until one node, the subroot, remains; the subroots of all
groups, by group, likewise give the root.

A node's label is (tree, level, number). Time-forward processing computes a
node when all that it needs has been sent to its label: messages wait in a
priority queue ordered by the receiver's label. The queue is external: between
rounds it is Spark's sorted shuffle, which deals messages by the upper part of
the label; within a round, a bounded block of ``fan ** height`` nodes goes
through a heap. Upwards, children send their digests to their parents. The
reversed sweep then goes through the same labels from the root down, and every
node sends its children the rest of their proof. So a tree of n leaves takes
log(n) / log(fan ** height) rounds each way, no task holds more than a block,
and a proof is put together only for its own leaf.
"""

from __future__ import annotations

from hashlib import sha256
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellfold.llm.common import checkpoint

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODES = "tree string, idx long, n long, digest string"
_ABOVE = "tree string, idx long, proof array<struct<before:string,after:string>>, subroot string, root string"


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields: ``-`` for null, else byte count, ``:``, value."""
    shown = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-"))
                             for f in shown]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``idx``, the row's number within its ``tree`` by ``order`` (nulls first), and
    ``n``, the rows of the tree. One sort over all trees, so a large tree is spread."""
    rows = checkpoint(rows.orderBy("tree", *[F.col(c).asc_nulls_first() for c in order]))
    rows = rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    parts = rows.groupBy("part", "tree").agg(F.min("place").alias("start"), F.count("*").alias("own"))
    # one short row for each part of a tree
    tree, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("part")
    parts = parts.select("part", "tree", (F.sum("own").over(before) - F.col("own") - F.col("start")).alias("shift"),
                         F.sum("own").over(tree).alias("n"))
    return (rows.join(parts, ["part", "tree"]).withColumn("idx", F.col("place") + F.col("shift"))
            .drop("part", "place", "shift"))


def levels(n: int, fan: int, height: int) -> int:
    """Levels that a round adds to a tree of n nodes."""
    h = 0
    while n > 1 and h < height:
        n, h = -(-n // fan), h + 1
    return h


def sweep_up(idx: list[int], digests: list[str], h: int, fan: int) -> tuple[dict, list]:
    """Children's digests of every inner node of a block, by label, and what is sent out of it."""
    queue = [(1, i // fan, i, d) for i, d in zip(idx, digests)]  # (label of the receiver, sender, digest)
    heapify(queue)
    runs: dict[tuple[int, int], list[tuple[int, str]]] = {}
    while queue and queue[0][0] <= h:
        level, node = queue[0][:2]
        run = runs[level, node] = []
        while queue and queue[0][:2] == (level, node):
            run.append(heappop(queue)[2:])
        digest = sha256("".join(d for _, d in run).encode()).hexdigest()
        heappush(queue, (level + 1, node // fan, node, digest))
    return runs, [(node, digest) for _, _, node, digest in sorted(queue)]


def sweep_down(runs: dict, top: list[int], h: int, above: list) -> dict[int, list]:
    """The proofs of a block's nodes: the runs in reversed label order, each sending on what is above it."""
    queue = [(-h, node, above) for node in top]
    heapify(queue)
    while queue and queue[0][0]:
        level, node, rest = heappop(queue)
        run = runs[-level, node]
        whole = "".join(d for _, d in run)
        for i, (child, _) in enumerate(run):
            step = (whole[:64 * i], whole[64 * (i + 1):])
            heappush(queue, (level + 1, child, [step, *rest]))
    return {node: proof for _, node, proof in queue}


def _proofs(rows: list[list[tuple[str, str]]]) -> pa.Array:
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    steps = pa.StructArray.from_arrays(
        [pa.array([s[k] for r in rows for s in r], pa.string()) for k in (0, 1)], names=["before", "after"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), steps)


def grow(nodes: DataFrame, fan: int, height: int) -> list[DataFrame]:
    """The rounds upwards: nodes of each (tree, idx, n, digest, maybe more); the last holds the roots."""
    size = fan ** height

    def up(t: pa.Table) -> pa.Table:
        tree, n = t["tree"][0].as_py(), t["n"][0].as_py()
        h = levels(n, fan, height)
        out = sweep_up(t["idx"].to_pylist(), t["digest"].to_pylist(), h, fan)[1]
        return pa.table({"tree": [tree] * len(out), "idx": pa.array([i for i, _ in out], pa.int64()),
                         "n": pa.array([-(-n // fan ** h)] * len(out), pa.int64()), "digest": [d for _, d in out]})

    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        last = rounds[-1].select("tree", "idx", "n", "digest", F.expr(f"idx div {size}").alias("block"))
        rounds.append(checkpoint(last.groupBy("tree", "block").applyInArrow(up, _NODES)))
    return rounds


def prove(rounds: list[DataFrame], above: DataFrame, fan: int, height: int) -> DataFrame:
    """The reversed sweep: the nodes of the first round with proof, subroot, root."""
    size = fan ** height

    def down(t: pa.Table, a: pa.Table) -> pa.Table:
        t, n = t.drop_columns(["block"]), t["n"][0].as_py()
        h = levels(n, fan, height)
        rest = [(s["before"], s["after"]) for s in a["proof"][0].as_py()]
        runs, out = sweep_up(t["idx"].to_pylist(), t["digest"].to_pylist(), h, fan)
        proofs = sweep_down(runs, [i for i, _ in out], h, rest)
        t = t.append_column("proof", _proofs([proofs[i] for i in t["idx"].to_pylist()]))
        for c in ("subroot", "root"):
            t = t.append_column(c, pa.array([a[c][0].as_py()] * t.num_rows, pa.string()))
        return t

    for nodes in reversed(rounds[:-1]):
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
        found = (nodes.withColumn("block", F.expr(f"idx div {size}")).groupBy("tree", "block")
                 .cogroup(above.withColumnRenamed("idx", "block").groupBy("tree", "block"))
                 .applyInArrow(down, f"{kinds}, " + _ABOVE.split("idx long, ")[1]))
        above = found.select("tree", "idx", "proof", "subroot", "root")
    if len(rounds) == 1:  # every tree is a single node
        found = rounds[0].join(above, ["tree", "idx"])
    return found


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
                    group_col: str = "source", fan: int = 16, height: int = 2,
                    **carried: Column) -> DataFrame:
    """One row per row: id, leaf, subroot, root, proof (array of before, after: the
    siblings of each level as hex digests), and ``carried`` columns by name.

    A null group is a group of its own and the first. Null ids come first;
    rows of one id go by their leaves, so equal rows may change places without
    any effect. A lone leaf is its subroot, a lone subroot the root. Fields may
    be null and of any type that casts to a string. An empty table gives no
    rows; other columns are not read. height: levels that are worked in one
    task, of ``fan ** height`` nodes at most.
    """
    nodes = docs.select(F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
                        F.col(id_col).alias("c_id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
                        *[c.alias(f"c_{k}") for k, c in carried.items()])
    rounds = grow(checkpoint(ranked(nodes, ["c_id", "digest"])), fan, height)
    tops = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("own"), "digest")
    tops = grow(checkpoint(ranked(tops, ["own"])), fan, height)
    above = tops[-1].select("tree", "idx", F.expr("cast(array() as array<struct<before:string,after:string>>)").alias("proof"),
                            F.lit("").alias("subroot"), F.col("digest").alias("root"))
    above = checkpoint(prove(tops, above, fan, height).select(
        F.col("own").alias("tree"), F.lit(0).cast("long").alias("idx"), "proof", F.col("digest").alias("subroot"), "root"))
    return prove(rounds, above, fan, height).select(
        F.col("c_id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "proof",
        *[F.col(f"c_{k}").alias(k) for k in carried])
