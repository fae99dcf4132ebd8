"""Learners on planted data and the registry."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.functions import text as tx
from loam.operators import metrics as mt
from loam.plans import models as md
from loam.plans import scoring as sc


def _planted(spark, n=4000):
    rng = np.random.default_rng(7)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    p = 1 / (1 + np.exp(-(0.5 + 1.5 * x1 - 2.0 * x2)))
    y = (rng.uniform(size=n) < p).astype(float)
    return spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x1, x2, y)],
                                 "x1 double, x2 double, y double")


def test_logit_recovers_planted_coefficients(spark):
    df = _planted(spark)
    model = md.fit_logit(df, "y ~ x1 + x2")
    tab = {r["term"]: r for r in md.coefficient_table(spark, model, sample=df).collect()}
    assert abs(tab["(Intercept)"]["estimate"] - 0.5) < 0.2
    assert abs(tab["x1"]["estimate"] - 1.5) < 0.25
    assert abs(tab["x2"]["estimate"] + 2.0) < 0.25
    assert tab["x1"]["std_error"] > 0


def test_text_classifier_separable(spark):
    rows = [(i, "zzq zzq qqz " * 5 if i % 2 else "abc abd abe " * 5, float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id int, text string, label double")
    stages = [tx.char_ngram_stage("text", "ngrams", 3)]
    from pyspark.ml.feature import HashingTF
    stages.append(HashingTF(inputCol="ngrams", outputCol="features", numFeatures=1 << 12))
    model = md.fit(df, None, "fastlinear_class", {"l1_weight": 1e-5, "l2_weight": 1e-4}, pre_stages=stages)
    scored = sc.score_label_raw_prob(model, df, ["doc_id", "label"])
    assert mt.bucketed_auc(scored, "Probability", "label").first()["auc"] > 0.9


def test_ensemble_mean_equals_mean_of_parts(spark):
    df = _planted(spark, 800).withColumn("part", (F.monotonically_increasing_id() % 2 + 1).cast("int"))
    models = md.fit_parts_ensemble(df, "part", 2, "y ~ x1 + x2", "linear_reg", {}, parallelism=2)
    ens = md.ensemble_predict(models, df, keep=["x1", "x2"]).orderBy("x1").collect()
    parts = [sc.score(m, df, ["x1"], "p", response=False).orderBy("x1").collect() for m in models]
    for i, r in enumerate(ens[:20]):
        assert abs(r["prediction"] - (parts[0][i]["p"] + parts[1][i]["p"]) / 2) < 1e-9


def test_learner_by_name_unknown():
    with pytest.raises(KeyError):
        md.learner("no_such_learner")


def test_formula_text():
    assert md.create_formula("y", ["y", "a", "b"]) == "y ~ a + b"
    assert md.create_formula("y", ["a", "b"], 2) == "y ~ (a + b)^2"


def test_registry_refuses_duplicate_version(spark, tmp_path):
    from loam.plans.registry import ModelRegistry
    df = _planted(spark, 300)
    model = md.fit(df, "y ~ x1", "logistic", {})
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    reg.save(model, "m", "1")
    with pytest.raises(ValueError):
        reg.save(model, "m", "1")
    reg.save(model, "m", "1", update=True)
    assert reg.load("m", "1") is not None
    assert reg.table().count() == 2
