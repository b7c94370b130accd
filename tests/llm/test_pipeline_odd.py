"""Null, empty, repeated and clashing rows, and empty tables, through all stages of the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

COLUMNS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with labels that vouch for the odd documents, so that they reach the later stages."""
    def write(docs):
        labels = docs.where("doc_id is not null").select("doc_id").distinct().withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(0))
        docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        labels.write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)
    return write


def test_odd_documents(spark, odd, tables):
    docs = odd.withColumn("whole", F.lit("taken"))  # clashes with names of the mix
    sf = tables(docs)
    docs, counts = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        columns, before = docs.columns, docs.count()
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name.replace(" ", "-"))
        counts.append((name, before, docs.count()))
        assert docs.columns == (COLUMNS if name == "byte-level BPE" else columns)
        if "keep" in docs.columns:
            assert {(r["keep"], r["whole"]) for r in docs.select("keep", "whole").distinct().collect()} == {("taken", "taken")}
    # Everything with a labelled neighbour passes; equal texts and repeated rows are one; no copy above three.
    (_, all_, good), (_, _, lined), (_, _, unique), (_, _, mixed), (_, _, tokens) = counts
    assert good <= all_ and lined == good and unique < lined and mixed <= 3 * unique and tokens == mixed > 0


def test_no_documents(spark, none, tables):
    sf = tables(none)
    docs = spark.read.schema(none.schema).parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name.replace(" ", "-"))
        assert docs.count() == 0
    assert docs.columns == COLUMNS
