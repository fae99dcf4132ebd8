"""Scoring (E01-E03, E11-E14, S09).

Scoring is ``PipelineModel.transform``: a narrow, per-partition map, so it
scales with the number of partitions and never shuffles.  Probability vectors
are unpacked with ``vector_to_array`` (JVM side, no Python UDF).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def _has(df: DataFrame, c: str) -> bool:
    return c in df.columns


def _formula_indexers(stage):
    """The fitted level lists of a formula's string columns: (column, first level,
    number of levels, indexer)."""
    for s in stage._java_obj.pipelineModel().stages():
        if s.getClass().getSimpleName() == "StringIndexerModel" and s.isSet(s.getParam("inputCol")):
            known = s.labelsArray()[0]
            yield s.getInputCol(), known[0] if len(known) else "", len(known), s


def _formula_columns(stage) -> set[str]:
    """The predictor columns of a formula."""
    terms = stage._java_obj.resolvedFormula().terms()
    return {terms.apply(i).apply(k) for i in range(terms.size()) for k in range(terms.apply(i).size())}


def _skips_rows(model: PipelineModel) -> bool:
    first = model.stages[0]
    return (first.hasParam("handleInvalid") and first.getOrDefault("handleInvalid") == "skip"
            and hasattr(first._java_obj, "resolvedFormula"))


def transform_all(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform`` that keeps every row of a batch or a stream: rows that a
    formula with ``handleInvalid='skip'`` cannot encode (a null, not a number or a
    level that it was not fitted on) come back with null outputs.

    Such a row goes through the model with a known level or 0 in its place and
    loses its outputs after; nothing is copied, joined or shuffled."""
    first = model.stages[0]
    if not _skips_rows(model):
        return model.transform(df)
    tag = "__row"
    while any(c.startswith(tag) for c in df.columns):
        tag += "_"
    used, kinds, given = _formula_columns(first), dict(df.dtypes), df
    valid, filled = F.lit(True), {}
    for i, (c, level, count, indexer) in enumerate(x for x in _formula_indexers(first) if x[0] in used):
        # the fitted indexer itself tells a level that it does not know from the others
        probe = indexer.copy(indexer.extractParamMap()).setHandleInvalid("keep").setOutputCol(f"{tag}level{i}")
        given = DataFrame(probe.transform(given._jdf), df.sparkSession)
        ok = F.col(f"{tag}level{i}") < count
        valid, filled[c] = valid & ok, F.when(ok, F.col(c)).otherwise(F.lit(level))
    for c in sorted(used - filled.keys()):
        ok = F.col(c).isNotNull() & (~F.isnan(c) if kinds[c] in ("double", "float") else F.lit(True))
        valid, filled[c] = valid & ok, F.when(ok, F.col(c)).otherwise(F.lit(0).cast(kinds[c]))
    given = given.withColumns({f"{tag}ok": valid, **{f"{tag}{i}": F.col(c) for i, c in enumerate(filled)}}).withColumns(filled)
    out = model.transform(given)
    back = {c: F.col(f"{tag}{i}") for i, c in enumerate(filled)}
    inner = {first.getOrDefault("featuresCol")}
    new = [c for c in out.columns if c not in given.columns and c not in inner]
    return out.select(*[back[c].alias(c) if c in back else F.col(c) for c in df.columns],
                      *[F.when(F.col(f"{tag}ok"), F.col(c)).alias(c) for c in new])


def score(model: PipelineModel, df: DataFrame, carry: Sequence[str] = (), name: str = "Score",
          response: bool = True) -> DataFrame:
    """Batch score with carried columns; ``response=True`` gives the
    positive-class probability for classifiers, the prediction otherwise."""
    out = transform_all(model, df)
    if response and _has(out, "probability"):
        s = vector_to_array("probability").getItem(1)
    else:
        s = F.col("prediction")
    return out.select(*carry, s.alias(name))


def score_label_raw_prob(model: PipelineModel, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``PredictedLabel``, ``Score`` (raw margin) and ``Probability``."""
    out = transform_all(model, df)
    cols = [*carry, (F.col("prediction") > 0.5).alias("PredictedLabel")]
    cols.append((vector_to_array("rawPrediction").getItem(1) if _has(out, "rawPrediction")
                 else F.col("prediction")).alias("Score"))
    cols.append((vector_to_array("probability").getItem(1) if _has(out, "probability")
                 else F.col("prediction")).alias("Probability"))
    return out.select(*cols)


def score_many(models: Mapping[str, PipelineModel], df: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Several models' scores side by side, one ``Score_<name>`` column per
    model; each model only sees the input columns, so stages cannot collide."""
    out = df
    # models that null their outputs by a flag last: later models would carry the flag's whole expression along
    for name, m in sorted(models.items(), key=lambda x: _skips_rows(x[1])):
        scored = transform_all(m, out)
        s = (vector_to_array("probability").getItem(1) if _has(scored, "probability") else F.col("prediction"))
        out = scored.select(*out.columns, s.alias(f"Score_{name}"))
    return out.select(*carry, *[f"Score_{n}" for n in models])


def write_scores(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Scored output sink (parquet, overwrite by default)."""
    df.write.mode(mode).parquet(path)
    return path


def score_query(spark: SparkSession, model: PipelineModel, query: str, carry: Sequence[str] = (),
                **tables: DataFrame) -> DataFrame:
    """Score the rows returned by a SQL query (placeholders bound to
    DataFrames); the query is planned and run by Spark, rows never leave it."""
    return score(model, spark.sql(query, **tables), carry)


def score_single(spark: SparkSession, model: PipelineModel, values: Mapping[str, object],
                 schema, derive=None, carry: Sequence[str] = ()) -> DataFrame:
    """One row built from raw inputs, optional derived columns
    (``derive(df) -> df``), then the model; returns the inputs, the derived
    columns named in ``carry`` and the scores."""
    one = spark.createDataFrame([tuple(values.values())], schema)
    if derive is not None:
        one = derive(one)
    return score_label_raw_prob(model, one, [*values, *carry])


def score_sets(model: PipelineModel, df: DataFrame, set_col: str, carry: Sequence[str]) -> DataFrame:
    """Independent row sets scored in one pass.  Scoring is a narrow
    per-partition map, so the sets need no co-location (repartitioning by a
    handful of set ids would funnel the data into that many tasks); the
    feature steps are inside the pipeline and run in the same pass."""
    return score_label_raw_prob(model, df, [set_col, *carry])
