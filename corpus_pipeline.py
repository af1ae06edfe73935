"""Corpus preparation: stages that each apply one text operator to what the stage before has kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. Stages
but the last return the columns of ``documents``. What a stage returns is written as Parquet under the
session's shared folder and read back as the next one's input, so a lost executor repeats one stage at most.

All rows of a document's table take part, those without id or text too: a text without words is never
toxic or contaminated and goes at the language stage, which keeps only texts with letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm import decontaminate, language_id, ngram_join, pieces, toxicity
from sheetloom.llm.common import free_name, table
from sheetloom.session import written

LEAST_SCORE = 0.3  # a text whose language is less certain than this is taken for noise
NEAR_SIZE, NEAR_PERCENT = 5, 80  # near copies: words of a shingle, and the similarity of sets that makes a copy


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier calls toxic; it learns from the labels of the documents at hand."""
    name = free_name(docs, "toxicity")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, model, into=name).where(F.col(name).predicted == 0).select(docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those that look like none of the learned languages."""
    name = free_name(docs, "language")
    found = language_id.identify(docs, language_id.fit(docs), into=name)
    return found.where((F.col(name).lang_pred != language_id.UNKNOWN) & (F.col(name).score >= LEAST_SCORE)).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of similar ones, that with the smallest id."""
    return ngram_join.keep_one(docs, size=NEAR_SIZE, percent=NEAR_PERCENT)


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain test items by the contamination rule."""
    name = free_name(docs, "contamination")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), into=name)
    return found.where(~decontaminate.is_contaminated(F.col(name).n_hit, F.col(name).n_words)).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add piece ids of the best segmentation, their number and score, and the scores of the next best."""
    name = free_name(docs, "pieces")
    r = F.col(name)
    made = {"piece_ids": r.ids, "n_pieces": r.n_pieces, "piece_score": r.score, "next_scores": F.transform(r.alternatives, lambda a: a.score)}
    return pieces.encode(docs, into=name).select(*[c for c in docs.columns if c not in made], *[v.alias(k) for k, v in made.items()])


STAGES = [("toxicity", not_toxic), ("language ID", known_language), ("n-gram Jaccard join", one_of_each),
          ("benchmark decontamination", not_contaminated), ("SentencePiece encoding", encoded)]

ORACLE_SQL = None  # models and lattice search are beyond SQL; tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
