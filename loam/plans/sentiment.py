"""A learned sentiment feature (M05): word weights as shrunk log-odds, out of fold.

A word's weight is the log-odds of a positive label among the labelled texts that
hold it, over the log-odds of all labelled texts, shrunk towards 0 by ``prior``
texts of the overall mix.  Every labelled row belongs to one of ``folds`` folds by a
hash of its key; its words are weighed by the labels of the other folds alone, so
no row is scored with its own label.  Rows without a label use all labels.

Words are counted per (word, fold) before they are shuffled, all folds in one
pass; the weights come back by an equi-join on the word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.text import word_tokens
from loam.operators.sampling import fold_id

PRIOR, FOLDS, SALT = 4.0, 3, 11


def words_of(df: DataFrame, key: str, text_col: str, label_col: str, folds: int = FOLDS, salt=SALT) -> DataFrame:
    """(key, fold, label, word): the distinct words of every text; fold 0 without a label."""
    fold = F.when(F.col(label_col).isNotNull(), fold_id(key, folds, salt)).otherwise(0)
    return df.select(F.col(key), fold.alias("fold"), F.col(label_col).cast("int").alias("label"),
                     F.explode(F.array_distinct(word_tokens(text_col, None))).alias("word"))


def _shrunk(p: Column, n: Column, pos: Column, neg: Column, prior: float) -> Column:
    share = pos / (pos + neg)
    return F.ln((p + prior * share) / (n + prior * (1 - share))) - F.ln(pos / neg)


def word_weights(df: DataFrame, key: str, text_col: str, label_col: str, folds: int = FOLDS, prior: float = PRIOR, salt=SALT) -> DataFrame:
    """(word, weights): entry 0 from all labels, entry k without those of fold k.
    Without a label of either kind outside a fold its weights are null."""
    labelled = df.where(F.col(label_col).isNotNull())
    y, fold = F.col(label_col).cast("int"), fold_id(key, folds, salt)
    totals = labelled.agg(*[F.count_if((y == v) & (fold != k)).alias(f"t{v}_{k}") for v in (0, 1) for k in range(folds + 1)]).first()
    counts = words_of(labelled, key, text_col, label_col, folds, salt).groupBy("word").agg(
        *[F.count_if((F.col("label") == v) & (F.col("fold") != k)).alias(f"c{v}_{k}") for v in (0, 1) for k in range(folds + 1)])

    def weight(k: int) -> Column:
        pos, neg = totals[f"t1_{k}"], totals[f"t0_{k}"]
        if not pos or not neg:
            return F.lit(None).cast("double")
        return _shrunk(F.col(f"c1_{k}"), F.col(f"c0_{k}"), F.lit(float(pos)), F.lit(float(neg)), prior)
    return counts.select("word", F.array(*[weight(k) for k in range(folds + 1)]).alias("weights"))


def learned_sentiment(df: DataFrame, key: str, text_col: str, label_col: str, name: str = "preSentiment", folds: int = FOLDS,
                      prior: float = PRIOR, salt=SALT) -> DataFrame:
    """(key, ``name``): the mean weight of a text's distinct words as a share in
    (0, 1); 0.5 where no word has a weight.  One row a key; keys tell rows apart."""
    from loam.session import materialize
    weights = materialize(word_weights(df, key, text_col, label_col, folds, prior, salt), "word-weights")
    hits = (words_of(df, key, text_col, label_col, folds, salt).join(weights, "word")
            .groupBy(key).agg(F.avg(F.get("weights", F.col("fold"))).alias("m")))
    return df.select(key).join(hits, key, "left").select(key, (1 / (1 + F.exp(-F.coalesce("m", F.lit(0.0))))).alias(name))
