"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage works on all rows its predecessor kept and is written before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import exact_dedup, language_id, near_dedup, packing, pii
from loamline.llm.queries import DEMO_KEY, tokenizer_path
from loamline.llm.tables import fresh, table
from loamline.staging import Scope, stage

# How far above an even share of the learned languages the best one must be, as a part of the way to 1: with four
# languages a text below 0.2875 counts as unidentified. Texts of a few clean words reach 0.35 and more.
MARGIN = 0.05


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach; unidentified ones go.

    A text that is null or has no letter goes. Where no row has a language, nothing can be learned and every text
    with a letter stays. Repeated rows repeat, empty tables stay empty, columns of any name stay as they are.
    """
    network = language_id.fit(docs)
    if not network.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    least = 1 / len(network.languages) + MARGIN * (1 - 1 / len(network.languages))
    rest = tuple(c for c in docs.columns if c != "doc_id")
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    found = language_id.identify(docs, network, keep=rest, names=(lang, score))
    accepted = (F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= least)
    return found.where(accepted).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest stays, then the one with the smallest id.

    Nulls count as empty texts, so one of all empty ones stays. Rows without id come last; of rows that are
    equal in all columns one stays. Empty tables stay empty, columns of any name stay as they are.
    """
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similarity 0.8 of five-word shingles, the smallest id stays.

    Texts without words, nulls included, are linked with nothing and stay; so do rows without id. Rows that share an id
    stay or go together. Empty tables stay empty, columns of any name stay as they are.
    """
    return near_dedup.keep_representatives(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms of the same format; n_chars follows the new text.

    No row goes: null and empty texts, repeated rows and rows without id stay. Columns of any name stay as they are.
    """
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    changed = pii.replace_personal_data(docs, DEMO_KEY, keep=rest, counted=False)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.char_length("text").cast(kind))
    return changed.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024; nulls are empty texts of one end token.

    Rows without id and repeated rows are packed one by one; an empty table gives no pieces.
    """
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", replace_personal_data),
    ("packing", pack),
]

# Trained models, sketches and keyed permutations are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. Tables that no later stage reads are dropped on the way."""
    docs, written = table(spark, sf_dir, "documents"), None
    for name, apply in STAGES:
        with Scope(spark) as scope:
            docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
        # The stage's own table was made last; the others, and its input, have been read.
        own = scope.paths.pop()
        if written is not None:
            scope.paths.append(written)
        scope.drop()
        written = own
    return docs
