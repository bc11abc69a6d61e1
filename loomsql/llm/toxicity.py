"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the hashed vectors of the word and its character n-grams, a text's the mean of its
words', so that unseen misspellings and inflections of a stem share most of its vectors. Word case is ignored.

Defined results: a null or empty text gets the score that the bias gives (the share of toxic labels); null ids are
never held out by chance, they count as the empty id; repeated rows score alike; extra columns play no part. Without
labels every score is 0.5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learn, subword

CONFIG = subword.Config(dim=4, epochs=12, rate=1.5)
#: Labels are learnt only from rows whose remainder by FOLDS isn't HELD_OUT.
FOLDS, HELD_OUT = 5, 0


def fit(docs: DataFrame, labels: DataFrame, per_class: int = learn.SAMPLE_PER_CLASS) -> subword.Model:
    return learn.fit(docs, labels, "toxic", learn.remainder("doc_id", FOLDS) != HELD_OUT, CONFIG, per_class)


def score_toxicity(docs: DataFrame, model: subword.Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    return learn.scored(docs, model, FOLDS, HELD_OUT)


def reject_toxic(docs: DataFrame, model: subword.Model) -> DataFrame:
    """The rows, with all their columns, that aren't predicted toxic."""
    return docs.where(learn.score(model, "text") < F.lit(0.5))
