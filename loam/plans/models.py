"""Learners (M01, M02, M06-M17) as ``pyspark.ml`` pipelines.

Every fit is a distributed Spark ML job.  A learner is chosen by name
(``LEARNERS``), the formula is an R-style string handled by ``RFormula``,
factor levels are fitted once on the full table and shared by train/test.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import RFormula, StringIndexer
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression,
                                   LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GLR_MAX_FEATURES = 4096   # GeneralizedLinearRegression's normal-equation limit


# ----------------------------------------------------------------- formulas
def create_formula(outcome: str, varnames: Sequence[str], interaction_pow: int = 1) -> str:
    """``y ~ a + b + ...``; with ``interaction_pow > 1`` all interactions
    up to that order, ``y ~ (a + b)^p``."""
    terms = " + ".join(v for v in varnames if v != outcome)
    if interaction_pow > 1:
        terms = f"({terms})^{interaction_pow}"
    return f"{outcome} ~ {terms}"


def formula_stage(formula: str, features_col: str = "features", label_col: str = "label",
                  handle_invalid: str = "keep") -> RFormula:
    """Formula -> label + feature vector; string columns are expanded to
    indicator columns (last level dropped), unseen levels kept as their own
    bucket at scoring time."""
    return RFormula(formula=formula, featuresCol=features_col, labelCol=label_col,
                    handleInvalid=handle_invalid)


def shared_level_indexers(full: DataFrame, cols: Sequence[str], suffix: str = "_idx") -> PipelineModel:
    """Factor levels found on the **full** table (train and test
    together), then applied to both so their codings agree."""
    stages = [StringIndexer(inputCol=c, outputCol=c + suffix, handleInvalid="keep",
                            stringOrderType="alphabetAsc") for c in cols]
    return Pipeline(stages=stages).fit(full)


# ----------------------------------------------------------------- learners
def _glr_binomial(**kw):
    return GeneralizedLinearRegression(family="binomial", link="logit", **kw)


LEARNERS: dict[str, Callable[..., object]] = {
    # Maximum-likelihood logistic regression with standard errors
    "logit": lambda **kw: _glr_binomial(**kw),
    # Regularised logistic regression (elastic net)
    "logistic": lambda **kw: LogisticRegression(**kw),
    # Linear model
    "linear": lambda **kw: LinearRegression(solver=kw.pop("solver", "normal"), **kw),
    "linear_reg": lambda **kw: LinearRegression(**kw),
    # Trees, forests, boosted trees
    "dtree_reg": lambda **kw: DecisionTreeRegressor(**kw),
    "dtree_class": lambda **kw: DecisionTreeClassifier(**kw),
    "forest_reg": lambda **kw: RandomForestRegressor(**kw),
    "forest_class": lambda **kw: RandomForestClassifier(**kw),
    "btrees_reg": lambda **kw: GBTRegressor(**kw),
    "btrees_class": lambda **kw: GBTClassifier(**kw),
    # Binary neural network
    "neuralnet_class": lambda **kw: MultilayerPerceptronClassifier(**kw),
}

TASK_KIND = {"logit": "classification", "logistic": "classification", "linear": "regression",
             "linear_reg": "regression", "dtree_reg": "regression", "dtree_class": "classification",
             "forest_reg": "regression", "forest_class": "classification", "btrees_reg": "regression",
             "btrees_class": "classification", "neuralnet_class": "classification",
             "fastlinear_class": "classification", "fastlinear_reg": "regression"}


def fast_linear(kind: str = "classification", l1_weight: float = 0.0, l2_weight: float = 1e-4,
                tol: float = 1e-3, max_iter: int = 200, **kw):
    """Linear classifier / regressor with L1 + L2 penalties by dual
    coordinate ascent: mean loss + l2/2 |w|^2 + l1 |w|_1, stopped at a duality
    gap of ``tol`` times the objective (``plans.dual``)."""
    from loam.plans.dual import FastLinear
    return FastLinear(kind=kind, l1=float(l1_weight), l2=float(l2_weight), tol=tol, maxIter=max_iter, **kw)


LEARNERS["fastlinear_class"] = lambda **kw: fast_linear("classification", **kw)
LEARNERS["fastlinear_reg"] = lambda **kw: fast_linear("regression", **kw)


def learner(name: str, **params):
    """Estimator by name."""
    if name not in LEARNERS:
        raise KeyError(f"unknown learner {name!r}; known: {sorted(LEARNERS)}")
    return LEARNERS[name](**params)


def fit(df: DataFrame, formula: str | None, name: str, params: dict | None = None,
        pre_stages: Sequence = (), features_col: str = "features", label_col: str = "label") -> PipelineModel:
    """Fit ``pre_stages`` + formula + learner as one pipeline (M01 + M16)."""
    params = dict(params or {})
    est = learner(name, featuresCol=features_col, labelCol=label_col, **params)
    stages = list(pre_stages)
    if formula:
        stages.append(formula_stage(formula, features_col, label_col))
    stages.append(est)
    return Pipeline(stages=stages).fit(df)


def fit_logit(df: DataFrame, formula: str, max_features: int = GLR_MAX_FEATURES,
              full: DataFrame | None = None, **params) -> PipelineModel:
    """Maximum-likelihood binomial GLM with coefficient standard
    errors.  A design above ``max_features`` columns is an error: the normal
    equations do not hold it, and the caller must name another learner.

    Factors are encoded with one real level as reference (full-rank design,
    as R does); their levels are those of ``full`` (train and test together,
    P12), by default of ``df``.  Rows that cannot be encoded (null predictor,
    level outside ``full``) are left out of the fit; scoring keeps them with a
    null score (``scoring.transform_all``)."""
    from pyspark import StorageLevel
    rf = formula_stage(formula, handle_invalid="skip").fit(df if full is None else full)
    width = vector_width(rf.transform(df))
    if width > max_features:
        raise ValueError(f"the design has {width} columns, more than {max_features}: use learner 'logistic'")
    est = _glr_binomial(**params)
    # IRLS passes over the data once per iteration and does not cache its input
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=[rf, est]).fit(data)
    finally:
        data.unpersist()


def vector_width(transformed: DataFrame, features_col: str = "features") -> int:
    """Length of an assembled feature vector, read from the column's ML
    metadata (analysis only, no job)."""
    meta = transformed.schema[features_col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return len(feature_names(transformed, features_col))


def feature_names(transformed: DataFrame, features_col: str = "features") -> list[str]:
    """Names of the vector slots from the column's ML attribute metadata."""
    meta = transformed.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [n for _, n in slots]


def coefficient_table(spark, model: PipelineModel, sample: DataFrame | None = None,
                      terms: Sequence[str] | None = None) -> DataFrame:
    """M06 summary / M17 listing: (term, estimate[, std_error, t_value, p_value]).

    Term names come from ``terms`` or from the feature metadata of the model's
    output on ``sample`` (one row is enough)."""
    last = model.stages[-1]
    if terms is None and sample is not None:
        terms = feature_names(model.transform(sample))      # schema metadata only, no job
    names = list(terms or [])
    coefs = list(last.coefficients.toArray()) if hasattr(last, "coefficients") else []
    rows = [("(Intercept)", float(getattr(last, "intercept", 0.0)))] + [
        (names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(coefs)]
    if last.__class__.__name__ != "GeneralizedLinearRegressionModel":
        return spark.createDataFrame(rows, "term string, estimate double")
    s = last.summary
    try:
        se, tv, pv = list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)
        # the GLM summary lists the intercept last
        se, tv, pv = [se[-1]] + se[:-1], [tv[-1]] + tv[:-1], [pv[-1]] + pv[:-1]
    except (Py4JJavaError, CapturedException) as e:
        # a singular design is solved iteratively and has no standard errors (plans.glm keeps those of the other terms)
        if "No Std. Error" not in str(e):
            raise
        se = tv = pv = [None] * len(rows)
    f = lambda v: None if v is None else float(v)
    rows = [(t, e, f(a), f(b), f(c)) for (t, e), a, b, c in zip(rows, se, tv, pv)]
    return spark.createDataFrame(
        rows, "term string, estimate double, std_error double, t_value double, p_value double")


# ----------------------------------------------------------------- ensemble
def fit_parts_ensemble(df: DataFrame, part_col: str, n_parts: int, formula: str,
                       name: str = "btrees_reg", params: dict | None = None,
                       parallelism: int = 4, full: DataFrame | None = None) -> list[PipelineModel]:
    """One model per disjoint part (H06), fitted concurrently: a driver
    thread pool submits the Spark fits, each a distributed job on its part.

    The formula is fitted once, on ``full`` (default: all parts), so every
    part's learner sees and scores the same encoding."""
    from pyspark import StorageLevel
    rf = formula_stage(formula).fit(df if full is None else full)
    data = rf.transform(df).select(part_col, "features", "label").persist(StorageLevel.MEMORY_AND_DISK)

    def one(p: int) -> PipelineModel:
        est = learner(name, featuresCol="features", labelCol="label", **dict(params or {}))
        return PipelineModel(stages=[rf, est.fit(data.where(F.col(part_col) == p))])
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            return list(ex.map(one, range(1, n_parts + 1)))
    finally:
        data.unpersist()


def ensemble_predict(models: Sequence[PipelineModel], df: DataFrame, name: str = "prediction",
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Mean of the parts' predictions as one column expression.

    The first model's formula/feature stages build the features once; every
    part's learner scores the same vector column."""
    keep = list(keep or df.columns)
    base = PipelineModel(stages=models[0].stages[:-1]).transform(df)
    out = base
    for i, m in enumerate(models):
        learner_model = m.stages[-1].copy()
        learner_model.setPredictionCol(f"_p{i}")
        out = learner_model.transform(out)
    mean = sum(F.col(f"_p{i}") for i in range(len(models))) / F.lit(float(len(models)))
    return out.select(*keep, mean.alias(name))
