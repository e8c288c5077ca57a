"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every source gets a target share of the mixture. A document's number of
copies is Poisson with mean (share x budget) / (size of its source), found by
inverting the distribution at a uniform number hashed from the seed and the
document id. Copies are exploded and put into one global random order, a sort
by a hash of seed, id and copy number.

A sum of Poisson numbers is Poisson, so a mean above PART (a tiny source with a
large target) is drawn in equal parts, each with a uniform number of its own.
No table of the distribution and no list of copies grows with the mean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sources up to which the table of rates is sent to every task.
BROADCAST_SOURCES = 10_000
SALTS = 32
#: The largest mean that is drawn at once.
PART = 256
_LIST = 1 << 16  # parts listed in one array


def _id(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _drawn_for(seed: int) -> Column:
    """'seed:id', and ':p<part>' behind it from the second part on."""
    return F.concat(F.lit(f"{seed}:"), F.col("id"), F.when(F.col("mix_part") == 0, "").otherwise(
        F.concat(F.lit(":p"), F.col("mix_part").cast("string"))))


def uniform(text: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the text's md5."""
    digits = F.substring(F.md5(text), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... far into the tail, in logarithms; as long as the rate is large."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40)
    step = lambda acc, k: F.struct(
        (acc["logp"] + F.log(rate) - F.log(k)).alias("logp"),
        F.concat(acc["cdf"], F.array(
            F.element_at(acc["cdf"], -1) + F.exp(acc["logp"] + F.log(rate) - F.log(k)))).alias("cdf"))
    start = F.struct((-rate).alias("logp"), F.array(F.exp(-rate)).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1).cast("long"), last), start, step, lambda a: a["cdf"])


def rates(docs: DataFrame, weights: DataFrame | None, budget: float | None,
          source_col: str, text_col: str) -> DataFrame:
    """(src, rate): one row per source of the table; sums are taken map-side first."""
    size = F.coalesce(F.length(text_col), F.lit(0)) + 1
    sizes = docs.groupBy(F.col(source_col).alias("src")).agg(F.sum(size).cast("double").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = weights.groupBy(F.col("source").alias("given")).agg(
            F.sum("weight").cast("double").alias("weight"))
        sizes = (sizes.join(given, F.col("src").eqNullSafe(F.col("given")), "left")
                 .withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))))
    total = sizes.agg(F.sum("size").alias("s"), F.sum("weight").alias("w")).first()
    asked = float(total["s"] or 0) if budget is None else float(budget)
    share = F.col("weight") / float(total["w"] or 1)
    return sizes.select("src", (share * asked / F.col("size")).alias("rate"))


def poisson_mix(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None,
                seed: int = 1, id_col: str = "doc_id", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """The columns of ``docs``, each row as often as its draws say, in global random
    order, with ``mix_part`` (0, 1, ...: the draw; 0 alone for means up to PART),
    ``mix_copy`` (1, 2, ... within the draw), ``mix_copies`` (the draw's number) and
    ``mix_key`` added.

    weights: (source, weight); sources not listed have weight 0; None means
    equal weights. budget: characters (one more per document) to aim at; None
    means as many as there are. A null source is a source of its own; a null
    text counts as empty; a null id hashes as ''. Repeated rows draw the same
    number. An empty table stays empty. Columns of ``docs`` with the names
    added here are replaced.
    """
    own = ["mix_part", "mix_copy", "mix_copies", "mix_key"]
    keep = [c for c in docs.columns if c not in own]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    rate = rates(docs, weights, budget, source_col, text_col)
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    pairs = docs.select(row, F.col(source_col).alias("src"), _id(id_col).alias("id"))
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("long")
    table = rate.filter("rate > 0").withColumn("parts", parts).select(
        F.col("src").alias("of"), "parts", poisson_cdf(F.col("rate") / F.col("parts")).alias("cdf"))
    same = F.col("src").eqNullSafe(F.col("of"))
    if rate.count() <= BROADCAST_SOURCES:
        joined = pairs.join(F.broadcast(table), same)
    else:  # deal a hot source out over several tasks
        joined = (pairs.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
                  .join(table.withColumn("salt_of", F.explode(F.sequence(
                      F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))),
                      same & (F.col("salt") == F.col("salt_of"))))
    lists = joined.withColumn("list", F.explode(F.expr(f"sequence(0L, (parts - 1) div {_LIST})")))
    draws = lists.withColumn("mix_part", F.explode(F.expr(
        f"sequence(list * {_LIST}, least(parts, (list + 1) * {_LIST}) - 1)")))
    # the one-element array has the uniform number worked out once, not for each k
    n = F.transform(F.array(uniform(_drawn_for(seed))),
                    lambda u: F.size(F.filter("cdf", lambda c: c < u)))[0]
    drawn = (draws.select("row", "id", "mix_part", n.alias("mix_copies"))
             .filter("mix_copies > 0"))
    copies = drawn.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    key = F.md5(F.concat(_drawn_for(seed), F.lit(":"), F.col("mix_copy").cast("string")))
    return (copies.withColumn("mix_key", key).orderBy("mix_key", "mix_part", "mix_copy")
            .select("row.*", *own))
