"""Text quality by non-negative positive-unlabelled learning.

Trusted texts are the positives, web text is unlabelled, and the share of good text in
it is estimated.  The classifiers see how a text is written: its symbols, capitals,
repeats and byte trigrams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starflow.llm import features, pu


def learn_quality(docs: DataFrame, trusted_ids: DataFrame, **settings) -> pu.Classifiers:
    """Classifiers from the texts of ``docs`` whose id is in ``trusted_ids``; see ``pu.learn``.

    The class prior is estimated unless ``prior`` gives it.  Rows without an id are not
    learnt from.  Without any trusted text every score is the least prior, 0.01.
    """
    return pu.learn(docs, trusted_ids, features.shape, features.SHAPE_WIDTH, features.SHAPE_ALWAYS,
                    **settings)


def score_quality(docs: DataFrame, model: pu.Classifiers, text_col: str = "text",
                  name: str = "score") -> DataFrame:
    """``docs`` without its text, and the probability that a text is of good quality.

    Every row is kept, also repeated ones; a null text scores as an empty one.  A column
    called ``name`` is replaced.
    """
    return pu.score(docs, model, features.shape, text_col, name)
