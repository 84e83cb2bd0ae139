"""Corpus preparation as a chain of stages, each written as Parquet and read again."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmon.llm.decontaminate import contamination
from sparkmon.llm.near_duplicates import near_duplicate_groups
from sparkmon.llm.packing import pack_documents
from sparkmon.llm.queries import PACK_VOCABULARY, table
from sparkmon.llm.shipping import ship
from sparkmon.llm.substring_dedup import cleaned_documents
from sparkmon.llm.tokens import tokenizer_path
from sparkmon.llm.toxicity import toxicity
from sparkmon.session import broadcast_if_small, scratch, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier calls toxic.

    Every row is judged by its own text, also where ids are null or repeated. Null and empty texts get the
    score of a text without terms. The rows pass through the scorer, so no text is shuffled.
    """
    with scratch(spark):
        judged = toxicity(docs, table(spark, sf_dir, "labels"), whole=True).filter("predicted = 0")
        text = F.col("text").cast(docs.schema["text"].dataType).alias("text")
        return judged.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group, the one with the smallest id.

    Rows that share an id are one document, of which the row with the smallest text stays. Rows with a null
    id and documents without words are linked with nothing and stay.
    """
    ship(spark)
    with scratch(spark):
        gone = stage(near_duplicate_groups(docs).filter("not kept").select("doc_id"), "rejected")
        left = docs.join(broadcast_if_small(stage(gone.distinct(), "rejected", outlives=True)), "doc_id", "left_anti")
        ids = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
        repeated = stage(ids, "repeated", outlives=True)
        if repeated.isEmpty():
            return left.select(docs.columns)
        row = F.struct(*[F.col(c) for c in docs.columns])
        first = F.min_by(row, F.struct("text", F.xxhash64(*docs.columns)))
        single = left.join(broadcast_if_small(repeated), "doc_id", "left_anti").select(docs.columns)
        several = left.join(broadcast_if_small(repeated), "doc_id", "left_semi")
        one = several.groupBy(F.col("doc_id").alias("_id")).agg(first.alias("_row")).select("_row.*")
        return single.unionByName(one)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take passages that an earlier document holds out of the texts.

    Rows with a null id or text stay as they are; rows that share an id don't take from one another.
    """
    ship(spark)
    return cleaned_documents(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark passages.

    Every row is judged by its own text, also where ids are null or repeated; null texts hold nothing.
    """
    with scratch(spark):
        # Decisions come back under the hash of a text; equal texts are judged alike.
        texts = docs.select(F.xxhash64(F.col("text").cast("string")).alias("doc_id"), "text")
        judged = contamination(texts, table(spark, sf_dir, "benchmark")).filter("contaminated")
        gone = stage(judged.select(F.col("doc_id").alias("text_hash")).distinct(), "rejected", outlives=True)
        same = F.xxhash64(docs["text"].cast("string")) == gone["text_hash"]
        return docs.join(broadcast_if_small(gone), same, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences; a null text is empty and a null id stays null."""
    ship(spark)
    name, mark, spaced, end_id = PACK_VOCABULARY
    return pack_documents(docs, tokenizer_path(name), mark, spaced, end_id)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", decontaminate),
    ("packing", pack),
]

# The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read back before the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
