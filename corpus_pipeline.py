"""The corpus pipeline: raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm import language_id, mixing, packing, secrets, simhash
from ledgerlift.llm.common import adopted, documents, free_name, written

#: Words of a block of the mix.
MIX_BLOCK = 256


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some confidence, which is then their `lang`; the others go.

    Null, empty and letterless texts have no language and go; texts of any length are read whole; repeated
    rows are judged alike; an empty table stays empty.  Columns keep their values whatever their names.
    """
    docs = adopted(docs)
    out = tuple(free_name(docs, n) for n in ("found", "score", "margin"))
    found = language_id.identified(docs, language_id.learned(docs), out=out)
    kept = found.where(language_id.accepted(*map(F.col, out)))
    return kept.select(*[(F.col(out[0]) if c == "lang" else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, three bits.

    Rows, texts and names are treated as `simhash.near_dedup` says: of repeated rows one stays, and of
    texts without words one.
    """
    return simhash.near_dedup(adopted(docs), shingle=3, max_bits=3)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked: null and empty texts and repeated rows stay as `secrets.redacted` says."""
    return secrets.redacted(adopted(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: stretches of documents, by source as often as the target weights ask for.

    A null source is one of its own; texts without words are not taken; repeated rows and names are
    treated as `mixing.mixture` says.
    """
    return mixing.mixture(adopted(docs), block=MIX_BLOCK)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of up to 2048 words: longer texts are cut, those without words are in none, repeated rows in several.

    Columns beside id, text and source don't matter; an empty table gives no sequence.
    """
    return packing.sequences(adopted(docs))


STAGES = [
    ("language", language_stage),
    ("near_dedup", dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is a table that the next one reads."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages learn, hash and pack; SQL can't express them.
ORACLE_SQL = None
