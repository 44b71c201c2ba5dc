"""The queries of this subpackage over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import (
    bpe,
    decontamination,
    importance,
    jaccard_join,
    langid,
    mtree,
    ngram_lm,
    qda,
    raking,
    token_counts,
    toxicity,
    vector_codes,
    vector_dedup,
)
from lotwise.llm.common import held_out, stored
from lotwise.plans.registry import table

MIXING_RATE = 0.5  # share of all tokens that mixing keeps
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


# Reachability over link(x, y): each node with itself and, by turns, with what its neighbours reach.
_CLASSES = """
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach(node, other) AS (
  SELECT x, y FROM edge UNION SELECT reach.node, edge.y FROM reach JOIN edge ON reach.other = edge.x
),
class AS (SELECT node, least(node, min(other)) AS low FROM reach GROUP BY node)"""

_VECTORS = """
vec AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)"""

_NEAR_SQL = f"""WITH RECURSIVE {_VECTORS},
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vec a JOIN vec b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, a.v) > 0 AND list_inner_product(b.v, b.v) > 0
    AND list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.9
), {_CLASSES}
SELECT vec_id, CAST((SELECT count(*) FROM edge WHERE x = vec_id) AS BIGINT) AS n_links,
       coalesce(low, vec_id) AS component_id, vec_id = coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN class ON vec_id = node"""

_TOP_SQL = f"""WITH {_VECTORS},
whole AS (SELECT vec_id, list_transform(v, lambda c: floor(256 * c)) AS v FROM vec),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) ranked WHERE rank <= 5"""

_JACCARD_SQL = f"""WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
),
shingled AS (
  SELECT doc_id, CASE WHEN len(ws) >= 4
      THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g
  FROM word
),
token AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM shingled),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM token a JOIN token b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), {_CLASSES}
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, coalesce(low, doc_id) AS component_id
FROM shingled LEFT JOIN class ON doc_id = node"""


_WORDS = """list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""

_DECONTAMINATION_SQL = f"""WITH word AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n,
         unnest(CASE WHEN len(ws) >= 10 THEN list_transform(range(1, len(ws) - 8), lambda i: array_to_string(ws[i:i + 9], ' '))
                     WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS w
  FROM item
),
place AS (
  SELECT doc_id, n, unnest(list_transform(range(1, len(ws) - n + 2),
         lambda i: {{'spot': i, 'w': array_to_string(ws[i:i + n - 1], ' ')}})) AS p
  FROM word JOIN (SELECT DISTINCT n FROM win) size ON len(ws) >= n
),
hit AS (SELECT DISTINCT doc_id, p.spot AS spot, place.n, item FROM place JOIN win ON place.n = win.n AND p.w = win.w),
covered AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(spot, spot + n)) AS spot FROM hit) GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS names
  FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM word LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""

# CRC-32 byte by byte: ``step`` is the table of its 256 remainders.
_IMPORTANCE_SQL = f"""WITH word AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents),
goal AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
step AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 1, 1, 1, 1, 1, 1, 1, 1],
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
),
coded AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(w)) + 1),
                  lambda i: CAST(instr('0123456789abcdef', lower(substr(hex(encode(w)), 2 * i - 1, 1))) * 16
                               + instr('0123456789abcdef', lower(substr(hex(encode(w)), 2 * i, 1))) - 17 AS BIGINT))),
                lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM (SELECT w FROM word UNION ALL SELECT w FROM goal)), step
),
source AS (SELECT bucket, count(*) AS s FROM word JOIN coded USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM goal JOIN coded USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
           CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM word) + 10000 AS DOUBLE)
           / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST((SELECT count(*) FROM goal) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM source FULL JOIN target USING (bucket)
),
weighed AS (
  SELECT doc_id, count(*) AS n_features, sum(gain) AS weight
  FROM word JOIN coded USING (w) JOIN gain USING (bucket) GROUP BY doc_id
),
drawn AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         list_reduce(list_prepend(0, list_transform(range(1, 9),
           lambda i: instr('0123456789abcdef', substr(sha256('2024:' || doc_id), i, 1)) - 1)), lambda a, b: 16 * a + b) AS h
  FROM documents LEFT JOIN weighed USING (doc_id)
),
scored AS (
  SELECT doc_id, n_features, weight,
         weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM drawn
),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS many
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT doc_id, rank FROM ranked WHERE rank <= many * 10 // 100) best USING (doc_id)"""


def _assigned(entries: str, name: str) -> str:
    """SQL for the nearest entry of each part: ties go to the lower index."""
    apart = " + ".join(f"(part.p[{i}] - {entries}.p[{i}]) * (part.p[{i}] - {entries}.p[{i}])" for i in range(1, 5))
    return f"""{name} AS (
  SELECT vec_id, spot, min(struct_pack(d := {apart}, e := entry)) AS near
  FROM part JOIN {entries} USING (spot) GROUP BY vec_id, spot
)"""


def _recentred(entries: str, assigned: str, name: str) -> str:
    """SQL for the entries after a round; unused ones stay."""
    means = ", ".join(f"CAST(floor(sum(part.p[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))
    return f"""{name} AS (
  SELECT spot, entry, coalesce(m, {entries}.p) AS p FROM {entries} LEFT JOIN (
    SELECT spot, near.e AS entry, [{means}] AS m FROM part JOIN {assigned} USING (vec_id, spot) GROUP BY spot, near.e
  ) mean USING (spot, entry)
)"""


_CODES_SQL = f"""WITH {_VECTORS},
part AS (
  SELECT vec_id, spot, list_transform(v[4 * spot + 1:4 * spot + 4], lambda c: CAST(floor(256 * c) AS BIGINT)) AS p
  FROM vec, (SELECT unnest(range(16)) AS spot) places
),
book0 AS (
  SELECT spot, p, entry FROM part JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM vec ORDER BY vec_id LIMIT 64
  ) first USING (vec_id)
),
{_assigned("book0", "round0")}, {_recentred("book0", "round0", "book1")},
{_assigned("book1", "round1")}, {_recentred("book1", "round1", "book2")},
{_assigned("book2", "last")},
code AS (
  SELECT vec_id, string_agg(lower(printf('%02x', near.e)), '' ORDER BY spot) AS code, CAST(sum(near.d) AS BIGINT) AS error
  FROM last GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY spot, entry)) FROM book2) AS codebooks_sha256
FROM code JOIN embeddings USING (vec_id)"""


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Documents of the training folds with their label; several labels of a document all count."""
    marks = labels.select(F.col("doc_id").alias("_id"), F.col(label))
    train = docs.where(~held_out(F.col("doc_id"), 3, 1))
    return train.join(marks, F.col("doc_id") == F.col("_id")).drop("_id")


@query("op3_quality")
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    stats = stored(qda.statistics(docs), "quality-statistics")
    model = qda.fit(labelled(stats, table(spark, folder, "labels"), "quality").select("x", "quality"), "quality")
    return qda.score(stats, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        qda.predicted(F.col("score")).alias("predicted"),
    )


@query("op4_language")
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    fold = held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(docs.where(~fold))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", fold.alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    train = table(spark, folder, "labels").where(~held_out(F.col("doc_id"), 3, 1))
    model = toxicity.fit(toxicity.training_texts(docs, train, "toxic"), "toxic")
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        qda.predicted(F.col("score"), 0.7).alias("predicted"),
    )


@query("op9_byte_bpe")
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_vector_dedup", _NEAR_SQL)
def op5_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_dedup.near_duplicates(table(spark, folder, "embeddings"), "vec_id", "embedding", 0.9)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


@query("op8_top_k", _TOP_SQL)
def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = mtree.whole_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return mtree.top_k(vectors, vectors.where(F.col("id") % 50 == 0), 5)


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "n_words", "n_tokens")


def with_topic(docs: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Topic of a document: the cluster label of its vector, none without one."""
    labels = embeddings.select(F.col("vec_id").alias("_vec"), F.col("label").alias("topic"))
    labels = labels.groupBy("_vec").agg(F.min("topic").alias("topic"))
    return docs.join(labels, F.col("doc_id") == F.col("_vec"), "left").drop("_vec")


@query("op7_mixing")
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id",
        "source",
        "lang",
        raking.tokens(F.col("text")).alias("tokens"),
        raking.row_key("doc_id", "text").alias("key"),
    )
    docs = stored(with_topic(docs, table(spark, folder, "embeddings")), "mixing-documents")
    return raking.sample(docs, ("source", "lang", "topic"), "tokens", "key", rate=MIXING_RATE).select(
        "doc_id", "source", "lang", "topic", "tokens", "probability", "sampled"
    )


@query("op10_jaccard_join", _JACCARD_SQL)
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    classes = jaccard_join.jaccard_classes(table(spark, folder, "documents"), "doc_id", "text", 4, 85)
    return classes.withColumnRenamed("id", "doc_id")


@query("op1_ngram_lm")
def op1_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = ngram_lm.score(docs, held_out(F.col("doc_id"), 10, 0), "doc_id", "text")
    return scored.withColumnRenamed("id", "doc_id")


@query("op11_decontamination", _DECONTAMINATION_SQL)
def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontamination.find(docs, items, "doc_id", "text", "item_id", "text", width=10)
    return decontamination.contamination(found).withColumnRenamed("id", "doc_id")


@query("op12_importance_resampling", _IMPORTANCE_SQL)
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    drawn = importance.resample(docs, target, "doc_id", "text", "text", longest=1, buckets=10_000, seed="2024")
    return drawn.withColumnRenamed("id", "doc_id")


@query("op13_vector_codes", _CODES_SQL)
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, _ = vector_codes.compress(table(spark, folder, "embeddings"), "vec_id", "embedding", "label", parts=16)
    return coded.withColumnRenamed("id", "vec_id")
