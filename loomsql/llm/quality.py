"""Quality classifier: learned hashed word and character n-gram vectors averaged per document, softmax output.

All words and their character n-grams weigh alike in a document's mean. Words are runs without white space, with case
and punctuation, since these tell much of quality; a word that follows itself shares one vector for "repeated".

Defined results: a null or empty text gets the score that the bias gives (the share of good labels); a null id counts
as the empty id; repeated rows score alike; extra columns play no part. Without labels every score is 0.5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import learn, subword

CONFIG = subword.Config(dim=4, epochs=6, rate=1.0, lower=False, alnum=False, mean_of_words=False)
#: Labels are learnt only from rows whose remainder by FOLDS isn't HELD_OUT.
FOLDS, HELD_OUT = 3, 1


def fit(docs: DataFrame, labels: DataFrame, per_class: int = learn.SAMPLE_PER_CLASS) -> subword.Model:
    return learn.fit(docs, labels, "quality", learn.remainder("doc_id", FOLDS) != HELD_OUT, CONFIG, per_class)


def score_quality(docs: DataFrame, model: subword.Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    return learn.scored(docs, model, FOLDS, HELD_OUT)


def keep_good(docs: DataFrame, model: subword.Model) -> DataFrame:
    """The rows, with all their columns, that are predicted good."""
    return docs.where(learn.score(model, "text") >= F.lit(0.5))
