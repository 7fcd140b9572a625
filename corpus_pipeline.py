"""The corpus pipeline: five stages over ``documents``, each written and reread.

Defined cases, of every stage: an empty table gives an empty one; only the
columns of documents are read, so further columns cannot clash and are not
passed on; NULL lang, source and n_chars stay as they are; texts of any
length are taken whole. What a stage does with NULL ids and texts, empty
texts and repeated rows is said with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickfeat.llm import jaccard, mixing, pieces, secrets, toxicity
from clickfeat.llm.common import ready, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# The mixture's budget. Copies have just been removed, so no document is used twice.
MIX_SHARE, MIX_EPOCHS = 0.9, 1


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scorer does not reject.

    NULL and empty texts have the score of a text without votes and stay with clean
    ones; rows with a NULL doc_id are judged by their text; repeated rows each.
    """
    ready(spark)
    return toxicity.clean_documents(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id's, of repeated rows one.

    Documents without words are copies of nothing and stay, however often; a NULL
    doc_id stays only where its group has no other.
    """
    ready(spark)
    return jaccard.one_of_each(docs.select(COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; n_chars follows the text.

    NULL and empty texts stay as they are; repeated rows are masked each.
    """
    ready(spark)
    return secrets.redact(docs.select(COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target mixture takes.

    A NULL lang or source is a leaf of its own; texts without words cost nothing and
    are taken with their leaf's prefix; rows of one doc_id share a place in the order.
    """
    ready(spark)
    return mixing.mixed(docs.select(COLUMNS), MIX_SHARE, MIX_EPOCHS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text.

    NULL texts have NULL ids, empty ones none; repeated rows are encoded each.
    """
    ready(spark)
    return pieces.piece_report(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

# The stages fit models and run automata, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's rows written and reread."""
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
