"""Cleaning and packing of the documents table in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last keep the
columns of documents. Rejected documents go; of each class of near-duplicates the document
of smallest id (and text hash) stays; repeated passages are cut out of the texts; what is left is packed
into sequences. Null and empty texts, repeated rows, null ids and further columns are
treated as each operator's docstring says; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from postloom.llm import neardup, packing, quality, substring, toxicity
from postloom.llm.common import keep_where, ship, table
from postloom.llm.queries import vocabulary_path
from postloom.runtime import delete, durable, scratch_path, temporary

#: Toxicity from which a document goes, and quality from which one stays.
TOXIC = 0.3
GOOD = 0.3


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't score as toxic; learned from the labels of those given."""
    model = toxicity.fit(docs, table(ship(spark), sf_dir, "labels"), F.lit(True))
    return keep_where(docs, toxicity.judge(model, TOXIC))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good; learned from the labels of those given. All stay if
    there is no label to learn from."""
    model = quality.fit(docs, table(ship(spark), sf_dir, "labels"), F.lit(True))
    return docs if model.weights is None else keep_where(docs, quality.judge(model, GOOD))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of smallest id and, among texts of
    one id, of smallest hash.

    Of rows of one id and text that one stays whose other columns come first as JSON. Rows of
    one id and different texts are documents each. Rows without id stay.
    """
    ship(spark)
    classes = neardup.classes(docs, firsts=True)
    other = classes.where("first <> struct(doc_id, text_id)").select(
        F.col("doc_id").alias("_gone"), F.col("text_id").alias("_gone_text")
    ).distinct()
    known = docs.where(docs["doc_id"].isNotNull()).withColumn("_text", F.xxhash64("text"))
    same = (known["doc_id"].cast("long") == other["_gone"]) & (known["_text"] == other["_gone_text"])
    left = known.join(other, same, "left_anti")
    rest = F.to_json(F.struct(F.lit(0), *[left[c] for c in docs.columns if c != "text"]))
    row = F.min_by(F.struct(*[left[c] for c in docs.columns]), rest)
    one = left.groupBy(left["doc_id"], left["_text"]).agg(row.alias("_row")).select("_row.*")
    return one.union(docs.where(docs["doc_id"].isNull()))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word passages of documents before them; untouched ones verbatim."""
    others = [c for c in docs.columns if c != "text"]
    ship(spark)
    cut = substring.dedup(docs, others, verbatim=True)
    made = {c: F.col("rest")[c] for c in others}
    if "n_chars" in made:
        made["n_chars"] = F.when(
            F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType)
        ).otherwise(made["n_chars"])
    made["text"] = F.col("kept")
    return cut.select(*[made[c].alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 4096 tokens."""
    ship(spark)
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity_filter),
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Classifiers, MinHash and best fit have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written to the shared folder.

    What a stage writes on its way goes when its rows are written, and its rows go when the next
    stage's are. Only what the last stage's result is read from is left.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "_"))
        with temporary(spark):
            docs = durable(stage(spark, docs, sf_dir), name, path)
        if last is not None:
            delete(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
