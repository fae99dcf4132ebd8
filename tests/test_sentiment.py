"""The learned sentiment feature."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from loam.functions import text as tx
from loam.operators import metrics as mt
from loam.plans import sentiment


def reviews(flip=None):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        y = i % 2
        own = rng.choices(["lovely", "superb", "warm"] if y else ["dull", "tedious", "cold"], k=2)
        rows.append((i, " ".join(rng.choices(["plot", "actor", "scene", "film"], k=6) + (own if i % 5 else [])), 1 - y if i == flip else y))
    return rows + [(900, "superb scene", None), (901, None, 1), (902, "", 0), (903, "unseen", None), (904, "onlyhere plot", 1)]


def test_own_label_is_not_used(spark):
    a, b = ({r.id: r.preSentiment for r in sentiment.learned_sentiment(
        spark.createDataFrame(reviews(f), "id int, text string, y int"), "id", "text", "y").collect()} for f in (None, 17))
    assert len(a) == 245 and a[17] == b[17] and a[900] != b[900]
    assert a[901] == a[902] == a[903] == 0.5 and abs(a[904] - 0.5) < 0.1 and a[900] > 0.6


def test_better_than_the_word_list(spark):
    df = spark.createDataFrame(reviews(), "id int, text string, y int").where("y is not null")
    learned = sentiment.learned_sentiment(df, "id", "text", "y").join(df, "id")
    auc = mt.exact_auc(learned, "preSentiment", "y").first().auc
    fixed = mt.exact_auc(df.withColumn("s", tx.lexicon_sentiment("text")), "s", "y").first().auc
    assert auc > 0.85 and auc > fixed + 0.2


def test_one_class_and_none(spark):
    df = spark.createDataFrame([(1, "a b", 1), (2, "a", 1)], "id int, text string, y int")
    assert {r.preSentiment for r in sentiment.learned_sentiment(df, "id", "text", "y").collect()} == {0.5}
    assert sentiment.learned_sentiment(df.where("id > 5"), "id", "text", "y").count() == 0


def test_sentiment_in_the_row_equals_the_join(spark):
    rows = [(1, "Good, GOOD and bad!"), (2, None), (3, ""), (4, "nothing"), (5, "schlecht bien " * 50)]
    df = spark.createDataFrame(rows, "id int, text string")
    a = {r.id: r.s for r in df.select("id", tx.lexicon_sentiment("text").alias("s")).collect()}
    b = {r.id: r.s for r in tx.sentiment_scores(df, "id", "text", tx.lexicon_frame(spark), "s").select("id", F.col("s")).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
