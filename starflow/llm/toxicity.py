"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all else is unlabelled, also texts that
somebody marked as harmless.  The classifiers see words and beginnings of words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm import features, pu
from starflow.llm import text as T


def learn_toxicity(docs: DataFrame, toxic_ids: DataFrame, **settings) -> pu.Classifiers:
    """Classifiers from the texts of ``docs`` whose id is in ``toxic_ids``; see ``pu.learn``.

    The share of toxic texts is estimated unless ``prior`` gives it.  Rows without an id
    are not learnt from.  Without any toxic text every score is the least prior, 0.01.
    """
    return pu.learn(docs, toxic_ids, features.words, features.WORDS_WIDTH, features.WORDS_ALWAYS,
                    **settings)


def score_toxicity(docs: DataFrame, model: pu.Classifiers, text_col: str = "text",
                   name: str = "score") -> DataFrame:
    """``docs`` without its text, and the probability that a text is toxic.

    Every row is kept, also repeated ones; a null text scores as an empty one.  A column
    called ``name`` is replaced.
    """
    return pu.score(docs, model, features.words, text_col, name)


def held_out_scores(docs: DataFrame, labels: DataFrame, label: str, learn, score,
                    threshold: float) -> DataFrame:
    """Fit on four of five folds of ``crc32(doc_id)`` and score all rows: ``doc_id, score, held_out, predicted``.

    Every row of ``docs`` is returned, also repeated ones and such without an id or text; a null id is in the
    fold of the empty text.  Other columns are left out, and an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    train = T.crc32_mod("doc_id", 5) != 0
    positives = labels.where((F.col(label) == 1) & train).select("doc_id")
    model = learn(docs.where(train), positives)
    scored = score(docs.withColumn("held_out", T.crc32_mod("doc_id", 5) == 0), model)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
