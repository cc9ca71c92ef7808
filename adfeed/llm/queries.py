"""The numbered operators on their whole tables, with SQL where it can say the same.

QUERIES: name -> function(spark, folder). ORACLE: name -> DuckDB SQL with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeed.llm import alignment, codes, embeddings, exact, html, idfiles, jaccard, lm, mixing, packing, quality, sharding, substrings
from adfeed.llm.common import octets, ready, shared_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_texts(table(spark, folder, "pages"))


def op2_two_pass_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shuffled_shards(table(spark, folder, "documents"), shards=16)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return placed.select(
        "doc_id", (octets("text") + 1).alias("size"), crc.alias("text_crc32"), "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_quantised_codes(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"), least=0.95)


def op4_poisson_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All sources at equal weight; digests in place of the texts."""
    mixed = mixing.mixed_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "copy", F.col("n_copies").cast("long").alias("n_copies"), "rate", F.md5("text").alias("text_md5"))


OP4_SQL = """
WITH d AS (SELECT doc_id, source, text, coalesce(strlen(text), 0) + 1 AS bytes FROM documents),
s AS (SELECT source, sum(bytes)::DOUBLE AS bytes FROM d GROUP BY source),
r AS (SELECT source, 1.0::DOUBLE / (SELECT count(*)::DOUBLE FROM s) * (SELECT sum(bytes) FROM s) / bytes AS rate FROM s),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 24)::BIGINT + 1)) AS k FROM r),
c AS (SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM k),
u AS (SELECT *, (('0x' || substr(md5('29|' || coalesce(doc_id::VARCHAR, text, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496 AS u FROM d),
n AS (SELECT u.doc_id, u.source, u.text, c.rate, count(*) FILTER (WHERE c.p <= u.u) AS n_copies
      FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source GROUP BY ALL)
SELECT doc_id, source, unnest(range(0, n_copies))::INT AS copy, n_copies, rate, md5(text) AS text_md5 FROM n WHERE n_copies > 0
"""


def op5_digest_index(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return exact.exact_duplicates(docs, exact.DigestIndex(spark, shared_path(spark, "digest-index")))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def op6_suffix_trees(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removed_counts(table(spark, folder, "documents"), width=20)


OP6_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT doc_id, i, list_aggregate(list_slice(words, i, i + 19), 'string_agg', ' ') AS span
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY span ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
g AS (SELECT doc_id, list(DISTINCT i + k) AS gone FROM r, (SELECT unnest(range(0, 20)) AS k) GROUP BY doc_id),
k AS (SELECT d.doc_id, d.words, coalesce(g.gone, []) AS gone FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, len(words) AS n_words, len(gone) AS n_removed,
       sha256(array_to_string(list_filter(words, lambda w, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256 FROM k
"""


def op7_log_frequency_filter(spark: SparkSession, folder: str) -> DataFrame:
    return lm.language_scores(table(spark, folder, "documents"))


def op8_global_orders(spark: SparkSession, folder: str) -> DataFrame:
    groups = jaccard.grouped(table(spark, folder, "documents"), shingle=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(list_slice(words, i, i + 3), 'string_agg', ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.other = l.x)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""


def op9_vector_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokens=1024)


def op10_trusted_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_id_planes(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "id-planes")
    idfiles.write_ids(table(spark, folder, "documents"), path, end=0)
    return idfiles.read_ids(spark, path)


def op12_grid_cells(spark: SparkSession, folder: str) -> DataFrame:
    return codes.coded(table(spark, folder, "embeddings"), positions=16, entries=64, rounds=2)


def _op12_assigned(book: str) -> str:
    """Each part with 64 * distance + entry of its nearest entry."""
    return f"""SELECT p.vec_id, p.pos, any_value(p.v) AS v, min((list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v)
      + list_inner_product(c.v, c.v))::BIGINT * 64 + c.e) AS best FROM p JOIN {book} c USING (pos) GROUP BY p.vec_id, p.pos"""


def _op12_replaced(book: str, assigned: str) -> str:
    """The entries after one round: floors of means, unused ones as they were."""
    return f"""SELECT c.pos, c.e, coalesce(m.v, c.v) AS v FROM {book} c LEFT JOIN (
      SELECT pos, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS v FROM (
        SELECT pos, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
          SELECT pos, best % 64 AS e, unnest(v)::BIGINT AS x, unnest(range(len(v))) AS i FROM {assigned}) GROUP BY pos, e, i)
      GROUP BY pos, e) m USING (pos, e)"""


OP12_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x, len(embedding) // 16 AS w FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, pos, list_slice(x, pos * w + 1, pos * w + w) AS v FROM k, (SELECT unnest(range(16)) AS pos)),
c0 AS MATERIALIZED (SELECT pos, e, v FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k) USING (vec_id) WHERE e < 64),
a0 AS MATERIALIZED ({_op12_assigned("c0")}),
c1 AS MATERIALIZED ({_op12_replaced("c0", "a0")}),
a1 AS MATERIALIZED ({_op12_assigned("c1")}),
c2 AS MATERIALIZED ({_op12_replaced("c1", "a1")}),
a2 AS MATERIALIZED ({_op12_assigned("c2")}),
h AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY pos, e, i)) AS codebooks_sha256
  FROM (SELECT pos, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM c2)),
o AS (SELECT vec_id, string_agg(printf('%02x', best % 64), '' ORDER BY pos) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM o JOIN k USING (vec_id), h
"""


def op13_spill_counting(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_page_differencing, op2_two_pass_shuffle, op3_quantised_codes, op4_poisson_mixing, op5_digest_index, op6_suffix_trees,
    op7_log_frequency_filter, op8_global_orders, op9_vector_best_fit, op10_trusted_perplexity,
    op11_id_planes, op12_grid_cells, op13_spill_counting,
)}
ORACLE = {"op4_poisson_mixing": OP4_SQL, "op5_digest_index": OP5_SQL, "op6_suffix_trees": OP6_SQL, "op8_global_orders": OP8_SQL, "op12_grid_cells": OP12_SQL}
