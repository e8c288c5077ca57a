"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Within a label, vectors are compared in tiles. Each unit vector u is stored as
int8 codes c with one scale s and the exact length e of the rest r = u - s c.
For two vectors

    u.v = s_u s_v c_u.c_v + (s_u c_u).r_v + r_u.v,

so the tile product of the codes is off by at most (1 + e_u) e_v + e_u. Only
pairs whose product plus this bound reaches the threshold are computed again
in double precision; no link is lost and none below the threshold is kept.

Tiles. Vectors of a label are laid out by their angle to a fixed direction,
in strips of about ``tile`` vectors (a strip of many equal angles is dealt
out over several tiles by a hash). Two strips whose angle ranges are further
apart than the threshold's angle hold no link, by the triangle inequality for
angles, and are never paired. A tile pair is one bounded group; it returns
link counts and one star per local component, never the pairs themselves, so
a large group of near copies makes rows in proportion to its members.

Copies (vectors of a label with the same unit vector) are one class, which
goes through the tiles once and counts as many links as it has members, so
the tile work grows with the distinct vectors only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellfold.llm.common import checkpoint
from cellfold.llm.graph import components

SLACK = 1e-9  # covers rounding of the bounds themselves
BIN = 0.002  # radians; resolution of the layout by angle

_CODED = ("vec_id long, label string, dim int, unit binary, codes binary, "
          "scale double, err double, angle double")


def direction(dim: int) -> np.ndarray:
    """The fixed direction that angles are measured against."""
    d = np.random.default_rng(dim).standard_normal(dim)
    return d / np.linalg.norm(d)


def encode(vector) -> tuple | None:
    """(unit, codes, scale, err, angle), or None for a vector that links with nothing."""
    if vector is None or len(vector) == 0:
        return None
    v = np.array([np.nan if x is None else x for x in vector], dtype=np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0 or not np.isfinite(v).all():
        return None
    v = v / top
    unit = v / np.sqrt(v @ v)
    scale = float(np.abs(unit).max() / 127)
    codes = np.rint(unit / scale).astype(np.int8)
    rest = unit - scale * codes
    angle = float(np.arccos(np.clip(unit @ direction(len(unit)), -1, 1)))
    return unit, codes, scale, float(np.sqrt(rest @ rest)) * (1 + 1e-12), angle


def coded(vectors: DataFrame) -> DataFrame:
    """Comparable rows (label, id and vector usable) in coded form."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, label, vec in zip(b["vec_id"], b["label"], b["vec"]):
                if (x := encode(vec)) is not None:
                    rows.append((i, label, len(x[0]), x[0].tobytes(), x[1].tobytes(), *x[2:]))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _CODED.split(", ")])

    return vectors.filter("label is not null and vec_id is not null").mapInPandas(run, _CODED)


def linked(a_unit, a_codes, a_scale, a_err, b_unit, b_codes, b_scale, b_err,
           threshold: float) -> np.ndarray:
    """Boolean matrix: cosine at or above the threshold."""
    kind = np.float32 if a_codes.shape[1] * 127 * 127 < 1 << 24 else np.float64  # exact sums
    product = (a_codes.astype(kind) @ b_codes.astype(kind).T).astype(np.float64)
    product *= a_scale[:, None]
    product *= b_scale[None, :]
    product += (1 + a_err)[:, None] * b_err[None, :] + a_err[:, None] + SLACK
    i, j = np.nonzero(product >= threshold)
    out = np.zeros(product.shape, dtype=bool)
    for k in range(0, len(i), 1 << 15):
        x, y = i[k:k + (1 << 15)], j[k:k + (1 << 15)]
        out[x, y] = np.einsum("ij,ij->i", a_unit[x], b_unit[y]) >= threshold
    return out


def tile_stars(a_ids: np.ndarray, b_ids: np.ndarray, a_size: np.ndarray, b_size: np.ndarray,
               link: np.ndarray, same: bool) -> list[tuple]:
    """(class, links, root) of every class with a link inside one tile pair; a link
    counts once for each member of the class at its other end."""
    low_a, low_b = a_ids.copy(), b_ids.copy()
    i, j = np.nonzero(link)
    while len(i):
        before = low_a.sum(dtype=object), low_b.sum(dtype=object)
        np.minimum.at(low_a, i, low_b[j])
        np.minimum.at(low_b, j, low_a[i])
        if same:
            low_a = low_b = np.minimum(low_a, low_b)
        if (low_a.sum(dtype=object), low_b.sum(dtype=object)) == before:
            break
    rows = [(int(v), int(n), int(r)) for v, n, r in zip(a_ids, link @ b_size, low_a) if n]
    if not same:
        rows += [(int(v), int(n), int(r)) for v, n, r in zip(b_ids, a_size @ link, low_b) if n]
    return rows


def embedding_groups(vectors: DataFrame, threshold: float = 0.98, tile: int = 2048,
                     id_col: str = "vec_id", vec_col: str = "embedding",
                     label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link at cosine >= threshold (double precision) when their labels
    are equal. Null labels or ids, and vectors that are null, empty, zero or
    hold a null or non-finite component, link with nothing and stay their own
    component; vectors of different lengths never link. Exactly repeated rows
    count once; rows that share an id but differ are vectors of their own,
    counted as others of each other where they link, and reported under their
    id: one row per row, with the links of all of them and one component. An
    empty table gives no rows; other columns are not read.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.col(label_col).cast("string").alias("label"),
                           F.col(vec_col).cast("array<double>").alias("vec"))
            .dropDuplicates())
    code = checkpoint(coded(rows))
    same_unit = ["label", "dim", "unit", "codes", "scale", "err", "angle"]  # all follow from unit
    classes = checkpoint(code.groupBy(*same_unit).agg(F.count("*").alias("size"))
                         .withColumn("cls", F.monotonically_increasing_id()))
    reach = float(np.arccos(threshold)) + 1e-6
    placed = classes.withColumn("bin", F.floor(F.col("angle") / BIN).cast("int"))
    bins = placed.groupBy("label", "dim", "bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("label", "dim").orderBy("bin")) - F.col("n")
    bins = bins.withColumn("strip", F.floor(before / tile).cast("int"))
    strips = bins.groupBy("label", "dim", "strip").agg(
        (F.min("bin") * F.lit(BIN)).alias("lo"), ((F.max("bin") + 1) * F.lit(BIN)).alias("hi"),
        F.ceil(F.sum("n") / tile).cast("int").alias("parts"))
    s, t = strips.alias("s"), strips.alias("t")
    partners = (s.join(t, ["label", "dim"])
                .filter((F.col("t.lo") - F.col("s.hi") <= reach)
                        & (F.col("s.lo") - F.col("t.hi") <= reach))
                .select("label", "dim", F.col("s.strip").alias("strip"),
                        F.col("s.parts").alias("parts"), F.col("t.strip").alias("other"),
                        F.explode(F.sequence(F.lit(0), F.col("t.parts") - 1)).alias("other_part")))
    mine = F.struct("strip", "part")
    theirs = F.struct(F.col("other").alias("strip"), F.col("other_part").alias("part"))
    work = (placed.join(bins.select("label", "dim", "bin", "strip"), ["label", "dim", "bin"])
            .join(partners, ["label", "dim", "strip"])
            .withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
            .select("label", "dim", F.least(mine, theirs).alias("x"),
                    F.greatest(mine, theirs).alias("y"), (mine <= theirs).alias("first"),
                    "cls", "size", "unit", "codes", "scale", "err"))

    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        same = key[2] == key[3]
        sides = []
        for side in (True, False):
            p = g[g["first"] == (side or same)].sort_values("cls")
            dim = int(key[1])
            sides.append((np.frombuffer(b"".join(p["unit"]), dtype=np.float64).reshape(-1, dim),
                          np.frombuffer(b"".join(p["codes"]), dtype=np.int8).reshape(-1, dim),
                          p["scale"].to_numpy(), p["err"].to_numpy(), p["cls"].to_numpy(),
                          p["size"].to_numpy()))
        a, b = sides
        link = linked(*a[:4], *b[:4], threshold)
        if same:
            np.fill_diagonal(link, False)
        return pd.DataFrame(tile_stars(a[4], b[4], a[5], b[5], link, same),
                            columns=["cls", "links", "root"])

    stars = checkpoint(work.groupBy("label", "dim", "x", "y").applyInPandas(
        run, "cls long, links long, root long"))
    own = classes.select("label", "dim", "unit", "cls", "size")
    members = checkpoint(code.select("vec_id", "label", "dim", "unit")
                         .join(own, ["label", "dim", "unit"]).select("vec_id", "cls", "size"))
    # rows of one id that lie in several classes tie these together
    spread = (members.groupBy("vec_id").agg(F.min("cls").alias("a"), F.max("cls").alias("top"))
              .filter("a < top").select("vec_id", "a"))
    ties = members.join(spread, "vec_id").filter("cls > a").select("a", F.col("cls").alias("b"))
    roots = components(stars.filter("root <> cls").select(
        F.col("root").alias("a"), F.col("cls").alias("b")).unionByName(ties))
    links = stars.groupBy("cls").agg(F.sum("links").alias("links"))
    # both joins are on the class: a class that holds a third of the rows is split by AQE
    known = (members.join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
             .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
                     F.coalesce("root", "cls").alias("root")))
    lowest = known.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    found = (known.join(lowest, "root").groupBy("vec_id")
             .agg(F.sum("links").alias("n_links"), F.min("component_id").alias("component_id")))
    return (rows.select("vec_id").join(found, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
