"""Documents to tokens: quality, repeated lines, near duplicates, mix of sources, encoding.

Every stage reads what the stage before it has written. Stages keep the columns of documents, extra
ones too, whatever their names; the last one returns token counts and digests. An empty table stays
one. What nulls, ties and repeated rows give is said at each stage.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fumarole.llm import jaccard, lines, mixing, neighbours
from fumarole.llm.common import fresh, held_out, stored
from fumarole.llm.queries import token_rows

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Score from which a document passes as good.
GOOD = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their labelled neighbours vouch for; null and empty texts go by the sample's share.

    Rows are judged one by one, so repeated rows and rows without doc_id fare as others with their text.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = neighbours.learn(docs, labels.where(~held_out(F.col("doc_id"))))
    column = fresh(docs, "score")
    return neighbours.score(docs, model, column).where(F.col(column) >= GOOD).drop(column)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a smaller doc_id holds; n_chars follows the text.

    Rows of one doc_id are one document, and keep what is in no smaller one; rows without doc_id keep
    all lines, null texts stay null.
    """
    kept = lines.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five words are alike by 0.8 or more.

    The smallest doc_id stays, and of repeated rows one; texts without words and rows without doc_id
    all stay.
    """
    return jaccard.one_of_each(docs, 5, (80, 100))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, three times at most.

    A null source is one of its own; rows that share a doc_id, and empty texts, follow its place.
    """
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; a null text has no tokens."""
    return token_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("source mix", source_mix),
    ("byte-level BPE", encoding),
]

#: The neighbours' votes cannot be told in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
