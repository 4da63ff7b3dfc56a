"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of ``documents``; the last one returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import decontam, langid, mixing, simhash, toxicity
from candlewick.llm.common import cut, documents, fresh_name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is identified; undetermined ones and narrow margins go."""
    model = langid.LanguageClassifier(langid.fit_dictionaries(docs))
    names = tuple(fresh_name(docs, n) for n in ("lang_pred", "score", "rejected"))
    judged = langid.identify(docs, model, names=names)
    return judged.where(~F.col(names[2])).select(*docs.columns)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose severity grade stays 0."""
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    names = tuple(fresh_name(docs, n) for n in ("grade", "expected_severity", "p_toxic", "toxic"))
    judged = toxicity.grade(docs, model, names=names)
    return judged.where(~F.col(names[3])).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark passages beyond the contract's share."""
    names = tuple(fresh_name(docs, n) for n in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated"))
    judged = decontam.decontaminate(docs, documents(spark, sf_dir, "benchmark"), names=names)
    return judged.where(~F.col(names[4])).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents taken, with their words taken (repeats counted)."""
    return mixing.mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("language ID", language_id),
    ("toxicity", remove_toxic),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", remove_contaminated),
    ("mixing sources to target weights", mix_sources),
]

#: Models and seeded picks are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each cut to a written table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
