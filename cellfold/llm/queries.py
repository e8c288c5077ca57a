"""The registered queries of this subpackage, and their DuckDB oracles.

Each query applies one operator, with production parameters, to its whole
table and derives the digest columns of its result from the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellfold.llm import chat, decontam, embed, fim, lm, merkle, mixing, pii, quality, simhash, suffix, token_files, tokencount
from cellfold.llm.common import id_text, table

MIX_SEED = 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = pii.train(pii.training_examples(docs))
    found = pii.personal_data(docs, model)
    joined = lambda c: F.array_join(F.transform(
        c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(
        F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS],
                        F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("all_spans").alias("spans"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"), seed=MIX_SEED)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("piece_bpe_32k.model"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(chat.format_conversations(turns.unionByName(own)))


def read_back(formatted: DataFrame, template: dict = chat.TEMPLATE) -> DataFrame:
    """Digests of what the formatted conversations say, read from their strings."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = chat.Format(template)
        for b in batches:
            rows = []
            for conv, text, spans, fault in zip(b["conv_id"], b["formatted"], b["loss_spans"], b["fault"]):
                turns = f.read(text)
                learned = "".join(f.unescape(text[s["start"]:s["end"]]) for s in spans)
                rows.append((conv, len(turns), "".join(f"{r}\n{t}\n" for r, t in turns),
                             len(learned), learned, len(text), fault))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "said", "loss_chars", "learned",
                                              "formatted_chars", "fault"])

    return (formatted.select(id_text("conv_id").alias("conv_id"), "formatted", "loss_spans", "fault")
            .mapInPandas(run, "conv_id string, n_turns long, said string, loss_chars long, "
                              "learned string, formatted_chars long, fault string")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "n_turns", F.sha2("said", 256).alias("turns_sha256"), "loss_chars",
                    F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
                    F.col("fault").isNull().alias("in_order")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digests(table(spark, sf_dir, "documents"))


def token_file_digests(docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder and read them back."""
    spark = docs.sparkSession
    path = token_files.token_file_path(spark)
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digests(token_files.read_token_files(spark, path))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(fim.restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


def op12_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", _UPPER, _LOWER)
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    seen = merkle.leaf_digest([F.when(tampered, lowered).otherwise(F.col(f)) if f == "text" else F.col(f)
                               for f in merkle.FIELDS])
    found = merkle.merkle_manifest(docs, seen=seen)
    return found.select("doc_id", "leaf", "subroot", "root",
                        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
                        merkle.fold(F.col("seen"), F.col("proof")).alias("folded_root")
                        ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(text: str) -> str:
    """DuckDB: digest of a row, its text taken from a column."""
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(
        f"coalesce(octet_length(encode({f}::VARCHAR)) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"


#: DuckDB: crc32 of the decimal doc_id, bit by bit
_CRC32 = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(
  regexp_extract_all(coalesce(doc_id::VARCHAR, ''), '.'), lambda c: ascii(c)::BIGINT)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)),
    lambda b, i: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END))"""
_CRC32 = f"xor({_CRC32}, 4294967295)"

QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_embeddings, op3_lm_scores, op4_decontaminate, op5_personal_data,
    op6_mix_sources, op7_token_counts, op8_chat, op9_quality, op10_token_files,
    op11_fill_in_middle, op12_repeated_strings, op13_manifest)}

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER
          + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE_SQL = {
    "op2_embeddings": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND n > 0 AND isfinite(n)
       AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
         ON a.label = b.label AND a.vec_id <> b.vec_id
         WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach(vec_id, seen) AS (
  SELECT vec_id, vec_id FROM v
  UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.seen),
comp AS (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM comp""",
    "op4_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, CASE WHEN len(w) < 10 THEN len(w) ELSE 10 END AS n,
               array_to_string(w[k:k + 9], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i)
        WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
gram AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes)),
hit AS (SELECT g.doc_id, g.n, g.p, win.item_id FROM gram g JOIN win ON g.n = win.n AND g.s = win.s),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit
       FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN own USING (doc_id)""",
    "op6_mix_sources": f"""
WITH d AS (SELECT *, length(coalesce(text, '')) + 1 AS size,
             '{MIX_SEED}:' || coalesce(doc_id::VARCHAR, '') AS who FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS size FROM d GROUP BY 1),
m AS (SELECT source, (1.0 / (SELECT count(*) FROM s)) * (SELECT sum(size) FROM s) / size AS mean FROM s),
r AS (SELECT source, parts, mean / parts AS rate
      FROM (SELECT *, greatest(ceil(mean / {mixing.PART}), 1)::BIGINT AS parts FROM m)),
pmf AS (SELECT source, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p
        FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 41)::BIGINT)) AS k FROM r)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
e AS (SELECT * REPLACE (CASE WHEN mix_part = 0 THEN who ELSE who || ':p' || mix_part END AS who)
      FROM (SELECT d.*, unnest(range(parts)) AS mix_part
            FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)),
u AS (SELECT *, (('0x' || substr(md5(who), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u FROM e),
n AS (SELECT u.doc_id, u.mix_part, count(*) FILTER (WHERE c < u) AS copies
      FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source GROUP BY 1, 2),
x AS (SELECT u.* EXCLUDE (size, u), unnest(range(1, copies + 1))::INTEGER AS mix_copy,
             copies::INTEGER AS mix_copies FROM u JOIN n USING (doc_id, mix_part))
SELECT * EXCLUDE (who), md5(who || ':' || mix_copy) AS mix_key FROM x""",
    "op8_chat": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(text, '(\\|\[/?INST\]|\[/?SYS\]|\[ANS\]|\[ROLE:|\[=\]|\[/ROLE\]|</?s>)', '\\\1', 'g') AS x,
  lag(role, 1, '') OVER w AS before, lead(role) OVER w AS after FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(length(x) + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
     ELSE 16 + length(regexp_replace(role, '(\\|\[/?INST\]|\[/?SYS\]|\[ANS\]|\[ROLE:|\[=\]|\[/ROLE\]|</?s>)', '\\\1', 'g')) END))::BIGINT AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN before = '' WHEN 'user' THEN before <> 'user'
     WHEN 'assistant' THEN before = 'user' ELSE false END AND (after IS NOT NULL OR role = 'assistant')) AS in_order
FROM e GROUP BY conv_id""",
    "op11_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l,
        list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(h, k, 8))::BIGINT) AS r FROM d),
c AS (SELECT *, len(l) AS n, least(r[1] % (len(l) + 1), r[2] % (len(l) + 1)) AS a,
        greatest(r[1] % (len(l) + 1), r[2] % (len(l) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100
             THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
x AS (SELECT *, coalesce(array_to_string(l[1:a], ''), '') AS p, coalesce(array_to_string(l[a + 1:b], ''), '') AS m,
        coalesce(array_to_string(l[b + 1:], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM x""",
    "op12_repeated_strings": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT r, c, len(x) // 2 - 199 - c AS n, substr(x, 2 * c + 1, 1400) AS y
      FROM (SELECT r, x, unnest(range(0, greatest(len(x) // 2 - 199, 0), 500)) AS c FROM d)),
w AS (SELECT r, c + p AS p, md5(substr(y, 2 * p + 1, 400)) AS h
      FROM (SELECT r, c, y, unnest(range(0, least(n, 500))) AS p FROM c)),
again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT r, p, p > lag(p, 1, -999) OVER (PARTITION BY r ORDER BY p) + 200 AS fresh FROM w JOIN again USING (h)),
part AS (SELECT r, p, sum(fresh::INT) OVER (PARTITION BY r ORDER BY p) AS k FROM hit),
span AS (SELECT r, k, min(p) AS a, max(p) + 200 AS b FROM part GROUP BY r, k),
gap AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS c FROM span),
own AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
               string_agg(substr(x, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) AS kept
        FROM gap JOIN d USING (r) GROUP BY r)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN own USING (r)""",
    "op13_manifest": f"""
WITH RECURSIVE f AS (SELECT *, CASE WHEN crc % 5 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END AS seen
  FROM (SELECT *, ({_CRC32}) AS crc FROM documents)),
l AS (SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql("seen")} AS seen FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
up AS (SELECT source, 0 AS level, i, leaf AS d, count(*) OVER (PARTITION BY source) AS n FROM r
  UNION ALL SELECT * FROM (SELECT source, level + 1 AS level, i // 16 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d,
    (max(n) + 15) // 16 AS n FROM up WHERE n > 1 GROUP BY source, level, i // 16)),
s AS (SELECT source, level AS height, d AS subroot FROM up WHERE n = 1),
t AS (SELECT 0 AS level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, subroot AS d, count(*) OVER () AS n FROM s
  UNION ALL SELECT * FROM (SELECT level + 1 AS level, i // 16 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d,
    (max(n) + 15) // 16 AS n FROM t WHERE n > 1 GROUP BY level, i // 16)),
top AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j FROM s),
runs AS (SELECT source, level, i // 16 AS g, list(d ORDER BY i) AS c FROM up WHERE n > 1 GROUP BY ALL),
truns AS (SELECT level, i // 16 AS g, list(d ORDER BY i) AS c FROM t WHERE n > 1 GROUP BY ALL),
fold AS (SELECT r.doc_id, r.source, r.i AS pos, 0 AS k, r.leaf, r.seen AS d, '' AS sib, top.height, top.subroot, top.j,
    (SELECT max(level) FROM t) AS tops
  FROM r JOIN top ON r.source IS NOT DISTINCT FROM top.source
  UNION ALL SELECT fold.doc_id, fold.source, CASE WHEN k + 1 = height THEN j ELSE pos // 16 END, k + 1, leaf,
    sha256(array_to_string(run[1:pos % 16], '') || d || array_to_string(run[pos % 16 + 2:], '')),
    sib || array_to_string(run[1:pos % 16], '') || array_to_string(run[pos % 16 + 2:], ''), height, subroot, j, tops
  FROM (SELECT f.* REPLACE (CASE WHEN f.height = 0 AND k = 0 THEN j ELSE pos END AS pos),
               coalesce(runs.c, truns.c) AS run
        FROM fold f LEFT JOIN runs ON f.k < f.height AND runs.source IS NOT DISTINCT FROM f.source
              AND runs.level = f.k AND runs.g = f.pos // 16
        LEFT JOIN truns ON f.k >= f.height AND truns.level = f.k - f.height
              AND truns.g = (CASE WHEN f.height = 0 AND k = 0 THEN f.j ELSE f.pos END) // 16
        WHERE f.k < f.height + f.tops) fold)
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, d AS folded_root, d = root AS verified
FROM fold, (SELECT d AS root FROM t WHERE n = 1) WHERE k = height + tops""",
}
