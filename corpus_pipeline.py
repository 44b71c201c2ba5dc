"""A cleaning pipeline over ``documents``, written and read again between its stages.

language -> toxicity -> near-duplicates -> mixing -> tokens. All stages but the last return
the columns of ``documents``; each works on all that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import bpe, jaccard_join, langid, raking, toxicity
from lotwise.llm.common import stored
from lotwise.llm.queries import MIXING_RATE, with_topic
from lotwise.plans.registry import table

LEAST_LANGUAGE_SHARE = 0.5
TOXIC = 0.7
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _unused(docs: DataFrame, name: str, *others: str) -> str:
    """``name``, or one made from it, that no column has."""
    taken = {column.lower() for column in (*docs.columns, *others)}
    while name.lower() in taken:
        name += "_"
    return name


def _set_aside(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns renamed that an operator would overwrite, and the columns as they were."""
    held = {name: _unused(docs, f"kept_{name}", *added) for name in docs.columns if name.lower() in added}
    return docs.withColumnsRenamed(held), [F.col(held.get(name, name)).alias(name) for name in docs.columns]


def _with_places(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and, as ``name``, the file and row of each row, the same whenever and wherever it is read.

    Documents that do not come straight from files are written first.
    """

    def placed(rows: DataFrame) -> DataFrame:
        file, row = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
        return rows.select(*docs.columns, F.struct(file.alias("file"), row.alias("row")).alias(name))

    try:
        return placed(docs)
    except AnalysisException:
        return placed(stored(docs, "pipeline-documents"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts of which one language has at least half of the letters.

    Rejected are null texts, texts without a letter, and texts that no language leads. The
    model is learned from the stage's own documents and their ``lang``; without any (an empty table, or
    no ``lang``) nothing is kept. Rows are judged one by one, so repeated rows and null ids stay or go by their
    text. Own columns come back as they were, whatever their names.
    """
    source, columns = _set_aside(docs, ("lang_pred", "lang_score", "spans"))
    found = langid.identify(source, langid.fit(docs))
    clean = (F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_LANGUAGE_SHARE)
    return found.where(clean).select(*columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity score is at least 0.7, learned from up to 50,000 labelled ones.

    A score of exactly 0.7 goes. Null and empty texts have no terms and the lowest score, and stay; so does
    everything when no label is known. Each row is judged by its text, repeated rows and
    null ids alike. Own columns come back as they were, whatever their names.
    """
    train = toxicity.training_texts(docs, table(spark, sf_dir, "labels"), "toxic")
    source, columns = _set_aside(docs, ("hits", "score"))
    scored = toxicity.score(source, toxicity.fit(train, "toxic"))
    return scored.where(F.col("score") < TOXIC).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near-duplicates: that of the smallest id, null ids last.

    Five-word shingles and a Jaccard similarity of at least 0.8. Classes are of rows, not of ids: rows that
    repeat an id with another text are documents of their own, and of rows that repeat a text
    one stays, whether their ids are equal, different or null. Null and empty texts, and those without
    words, are in no class and all stay.
    """
    place, copy = _unused(docs, "_place"), _unused(docs, "_copy")
    placed = _with_places(docs, place)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(place).alias("place"))
    rows = placed.select(order.alias("row"), "text")
    classes = jaccard_join.jaccard_classes(rows, "row", "text", width=5, percent=80)
    copies = classes.where(F.col("component_id") != F.col("id")).select(F.col("id.place").alias(copy))
    return placed.join(copies, F.col(place) == F.col(copy), "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample half of the tokens so that sources, languages and topics get their softened shares.

    Values and cells too small for their share are kept whole. Rows with a null id are drawn by
    their text; texts without a word have no weight and are not drawn.
    """
    key = raking.row_key("doc_id", "text")
    weights = docs.select("doc_id", "source", "lang", raking.tokens(F.col("text")).alias("tokens"), key.alias("key"))
    weights = stored(with_topic(weights, table(spark, sf_dir, "embeddings")), "mixing-documents")
    drawn = raking.sample(weights, ("source", "lang", "topic"), "tokens", "key", rate=MIXING_RATE)
    own = _unused(docs, "_drawn")
    drawn = drawn.where("sampled").select(F.col("key").alias(own)).distinct()
    return docs.join(drawn, key == F.col(own), "left_semi").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text's bytes again.

    A null text counts as the empty one, which has no ids; each row gives one row.
    """
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == text).alias("round_trip"),
        "ids",
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("encoding", encoding),
]

# The first, second, fourth and fifth stage fit models or walk automata, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
