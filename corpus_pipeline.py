"""From raw documents to packed training sequences, one operator after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. run() writes what a stage
returns as Parquet into the shared folder and gives it, reread, to the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geokernel.llm import exact_dedup, language_id, near_dedup, packing, toxicity
from geokernel.llm.shared import as_table, read_table, with_row_key


def _only(keyed: DataFrame, name: str, rows: DataFrame) -> DataFrame:
    """The rows of keyed whose column `name` is among the row_keys, without that column."""
    return keyed.join(rows.select(F.col("row_key").alias(name)), name, "left_semi").drop(name)


def _bare(docs: DataFrame) -> tuple[DataFrame, list]:
    """doc_id, text and the other columns in one struct, where no result's name can clash with
    theirs; and what selects the columns as they were."""
    other = [c for c in docs.columns if c not in ("doc_id", "text")]
    fields = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(other)] or [F.lit(0).alias("none")]
    place = {c: F.col(f"row.c{i}").alias(c) for i, c in enumerate(other)}
    return docs.select("doc_id", "text", F.struct(*fields).alias("row")), [place[c] if c in place else F.col(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity chain, fitted on `labels`, does not reject.

    Each row is judged by its own text, so rows that repeat a doc_id, or have none, are judged
    apart. Null, empty and letterless texts stay; without labelled toxic rows all stay. All
    columns stay; the operator's own columns do not clash with them, since they are left out."""
    labels = read_table(spark, sf_dir, "labels")
    chain = toxicity.fit_from_labels(docs, labels)
    bare, back = _bare(docs)
    return toxicity.score_documents(bare, chain, keep_columns=True).filter(~F.col("rejected")).select(*back)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language the model is sure enough of.

    Null, empty and letterless texts go; without any labelled row there is no model and all
    texts go. Every row is judged by its own text; all columns stay, as in drop_toxic."""
    model = language_id.fit_from_documents(docs)
    bare, back = _bare(docs)
    return language_id.identify(bare, model, keep_columns=True).filter(~F.col("rejected")).select(*back)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text that is equal up to white space: the one with the smallest doc_id.

    Of rows that repeat that doc_id, and where no row has one, a single row stays. Null texts
    count as empty ones. Decisions go by row, not by doc_id, so another text under the same
    doc_id is not touched."""
    keyed, name = with_row_key(docs)
    # Decisions are written first, so that a large group is combined before it is shuffled.
    kept = as_table(exact_dedup.dedup_documents(keyed, row_col=name), "decisions").filter("kept")
    return _only(keyed, name, kept.groupBy("digest").agg(F.min("row_key").alias("row_key")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the one with the smallest doc_id.

    Of rows that repeat that doc_id within the component, and where no row has one, a single row
    stays. Texts without words are near to nothing and stay. Decisions go by row."""
    keyed, name = with_row_key(docs)
    kept = near_dedup.near_duplicates(keyed, row_col=name).filter("kept")
    one = kept.filter("group IS NOT NULL").groupBy("group").agg(F.min("row_key").alias("row_key")).select("row_key")
    return _only(keyed, name, one.union(kept.filter("group IS NULL").select("row_key")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces of sequences of 4096 tokens; a row for each piece.

    Null and empty texts are their end id alone; rows that repeat a doc_id, or have none, are
    packed as documents of their own; an empty table packs to nothing."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: The first two stages fit models and the last one runs a tokenizer: no SQL can express them.
#: tests/llm/test_pipeline.py holds the deterministic stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = as_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
