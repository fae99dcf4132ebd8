"""Checks for features, learners, scoring, registry and the scoring stream
(M01-M17, P12, E01-E03, E09, E11-E14, S09, S12, S13, N01).

Model quality has no SQL oracle: these are rows-only checks backed by pytest
(planted coefficients, separable text).  Feature steps (P12, M03-M05) have
SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loam.functions import text as tx
from loam.functions.geo import haversine_miles, haversine_sql
from loam.operators import metrics as mt
from loam.operators import sampling as smp
from loam.operators.relational import constant_columns
from loam.plans import flights as fw
from loam.plans import dual, glm
from loam.plans import models as md
from loam.plans import scoring as sc
from loam.plans import sentiment
from loam.plans import textlinear as tl
from loam.plans import trees
from loam.plans.dual import Setting
from loam.session import materialize, read_table, scratch_path
from loam.sources.views import view, with_ctes, with_views
from loam.suite import query, r6, s6
from loam.suite_relational import HOLDOUT_KEYS, flights_weather

WEATHER_VARS = [m + s for s in ("Origin", "Dest") for m in fw.WEATHER_MEASURES]
FLIGHT_VARS = ["Year", "Month", "DayOfMonth", "DayOfWeek", "Carrier", "OriginAirportID", "DestAirportID",
               "CRSDepTime", "CRSArrTime"] + WEATHER_VARS


# ----------------------------------------------------------------- model inputs
def flight_model_frame(spark, sf):
    """Flights with weather, label known, airports as factors, complete rows."""
    f = flights_weather(spark, sf).where(F.col("ArrDel15").isNotNull())
    f = f.withColumns({"OriginAirportID": F.col("OriginAirportID").cast("string"),
                       "DestAirportID": F.col("DestAirportID").cast("string"),
                       "CRSDepTime": F.col("CRSDepTime").cast("double")})
    return f.dropna(subset=FLIGHT_VARS)


def flight_formula(df, vars_=FLIGHT_VARS) -> str:
    """The flight formula without columns that hold one value in ``df``."""
    const = set(constant_columns(df, vars_))
    return md.create_formula("ArrDel15", [v for v in vars_ if v not in const])


def with_constant_terms(coefs, df, vars_):
    """A coefficient table with the terms that hold one value in ``df``: they
    cannot be told from the intercept and have no estimate."""
    rows = [(v, None) for v in constant_columns(df, vars_)]
    if not rows:
        return coefs
    gone = df.sparkSession.createDataFrame(rows, "term string, estimate double")
    return coefs.unionByName(gone, allowMissingColumns=True)


def flight_split(spark, sf):
    f = flight_model_frame(spark, sf)
    return fw.time_split(f, (2024, 1, 22), (2024, 1, 22), (2024, 2, 1))


def text_frame(spark, sf):
    """Documents with quality labels, whole texts."""
    d = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    lab = read_table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return d.join(lab, on="doc_id")


def trip_model_frame(spark, sf):
    t = view(spark, sf, "trips")
    return t.withColumn("direct_distance", haversine_miles("pickup_longitude", "pickup_latitude",
                                                           "dropoff_longitude", "dropoff_latitude"))


TRIP_VARS = ["passenger_count", "trip_distance", "trip_time_in_secs", "direct_distance"]
TRIP_FORMULA = f"tipped ~ {' + '.join(TRIP_VARS)}"


# ----------------------------------------------------------------- P12 / M01-M05
@query("P12_shared_factor_levels", with_ctes(["flights"], """
lv AS (SELECT Carrier, CAST(dense_rank() OVER (ORDER BY Carrier) - 1 AS DOUBLE) AS Carrier_idx
       FROM (SELECT DISTINCT Carrier FROM flights WHERE Carrier IS NOT NULL))""",
    "SELECT CASE WHEN f.DayOfMonth < 22 THEN 'train' ELSE 'test' END AS split, f.Carrier, lv.Carrier_idx, "
    "count(*) AS n FROM flights f JOIN lv ON f.Carrier = lv.Carrier GROUP BY 1, 2, 3"))
def q_p12(spark, sf):
    full = view(spark, sf, "flights")
    idx = md.shared_level_indexers(full, ["Carrier"])
    train, test = fw.time_split(full, (2024, 1, 22), (2024, 1, 22), (2024, 2, 1))
    parts = [idx.transform(d).withColumn("split", F.lit(s)) for s, d in (("train", train), ("test", test))]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("split", "Carrier", "Carrier_idx").agg(F.count(F.lit(1)).alias("n"))


_CLEAN_SQL = ("regexp_replace(regexp_replace(translate(lower(text), '{a}', '{u}'), '{d}', '', 'g'), '{p}', '', 'g')"
              .format(a=tx.ACCENTED, u=tx.UNACCENTED, d=tx.DIGIT_CLASS, p=tx.PUNCT_CLASS))


@query("M03_char_ngram_features", with_ctes([], f"""
c AS (SELECT doc_id, {_CLEAN_SQL} AS t FROM documents),
g AS (SELECT doc_id, substr(t, i, 3) AS ngram FROM c, range(1, greatest(length(t) - 3 + 2, 2)) r(i)
      WHERE length(substr(t, i, 3)) = 3),
tf AS (SELECT doc_id, ngram, count(*) AS tf FROM g GROUP BY 1, 2)""",
    "SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n_terms, count(*) AS n_distinct, max(tf) AS max_tf, "
    "CAST(sum(CASE WHEN ngram = 'the' THEN tf ELSE 0 END) AS BIGINT) AS tf_the FROM tf GROUP BY doc_id"))
def q_m03(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    tf = tx.ngram_term_counts(d, "doc_id", "text", 3)
    return tf.groupBy("doc_id").agg(F.sum("tf").alias("n_terms"), F.count(F.lit(1)).alias("n_distinct"),
                                    F.max("tf").alias("max_tf"),
                                    F.sum(F.when(F.col("ngram") == "the", F.col("tf")).otherwise(0)).alias("tf_the"))


_SW = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)


@query("M04_word_counts_l2", with_ctes(["reviews"], f"""
w AS (SELECT doc_id, unnest(string_split_regex(translate(lower(review), '{tx.ACCENTED}', '{tx.UNACCENTED}'), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM reviews),
c AS (SELECT doc_id, word, count(*) AS n FROM w WHERE length(word) > 0 AND word NOT IN ({_SW}) GROUP BY 1, 2)""",
    f"SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_words, count(*) AS n_distinct, {s6('sqrt(sum(n * n))')} AS l2_norm FROM c GROUP BY doc_id"))
def q_m04(spark, sf):
    c = tx.word_counts(view(spark, sf, "reviews"), "doc_id", "review")
    out = c.groupBy("doc_id").agg(F.sum("n").alias("n_words"), F.count(F.lit(1)).alias("n_distinct"),
                                  F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("l2_norm"))
    return r6(out, "l2_norm")


_LEX = ", ".join(f"('{k}', {v!r}e0)" for k, v in sorted(tx.SENTIMENT_LEXICON.items()))


@query("M05_lexicon_sentiment_feature", with_ctes(["reviews"], f"""
w AS (SELECT doc_id, unnest(string_split_regex(translate(lower(review), '{tx.ACCENTED}', '{tx.UNACCENTED}'), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM reviews),
h AS (SELECT doc_id, avg(weight) AS aw FROM w JOIN (VALUES {_LEX}) lx(word, weight) USING (word) GROUP BY doc_id)""",
    f"SELECT r.doc_id, {s6('0.5e0 + coalesce(h.aw, 0e0) / 2')} AS preSentiment FROM reviews r LEFT JOIN h USING (doc_id)"))
def q_m05(spark, sf):
    r = view(spark, sf, "reviews")
    return r6(tx.sentiment_scores(r, "doc_id", "review", tx.lexicon_frame(spark)), "preSentiment")


@query("M05_sentiment_in_the_row", with_ctes(["reviews"], f"""
w AS (SELECT doc_id, unnest(string_split_regex(translate(lower(review), '{tx.ACCENTED}', '{tx.UNACCENTED}'), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM reviews),
h AS (SELECT doc_id, avg(weight) AS aw FROM w JOIN (VALUES {_LEX}) lx(word, weight) USING (word) GROUP BY doc_id)""",
    f"SELECT r.doc_id, {s6('0.5e0 + coalesce(h.aw, 0e0) / 2')} AS preSentiment FROM reviews r LEFT JOIN h USING (doc_id)"))
def q_m05_row(spark, sf):
    return r6(view(spark, sf, "reviews").select("doc_id", tx.lexicon_sentiment("review").alias("preSentiment")), "preSentiment")


_LEARNED = f"""
t AS (SELECT d.doc_id, d.text, l.quality AS label, CASE WHEN l.quality IS NULL THEN 0
      ELSE {smp.hash_sql(["d.doc_id"], sentiment.SALT)} % {sentiment.FOLDS} + 1 END AS fold FROM documents d LEFT JOIN labels l USING (doc_id)),
w AS (SELECT DISTINCT doc_id, fold, label, word FROM (SELECT doc_id, fold, label, unnest(string_split_regex(translate(lower(text),
      '{tx.ACCENTED}', '{tx.UNACCENTED}'), '[^\\p{{L}}\\p{{N}}]+')) AS word FROM t) WHERE length(word) > 0),
k AS (SELECT CAST(unnest(range(0, {sentiment.FOLDS + 1})) AS INT) AS k),
tot AS (SELECT k, count_if(label = 1) * 1e0 AS pos, count_if(label = 0) * 1e0 AS neg FROM k, t WHERE label IS NOT NULL AND fold <> k GROUP BY k),
voc AS (SELECT DISTINCT word FROM w WHERE label IS NOT NULL),
c AS (SELECT word, k, count_if(label = 1) AS p, count_if(label = 0) AS n FROM k, w WHERE label IS NOT NULL AND fold <> k GROUP BY word, k),
wt AS (SELECT word, k, ln((coalesce(p, 0) + {sentiment.PRIOR} * pos / (pos + neg)) / (coalesce(n, 0) + {sentiment.PRIOR} * (1 - pos / (pos + neg))))
              - ln(pos / neg) AS weight FROM voc CROSS JOIN tot LEFT JOIN c USING (word, k))"""


@query("M05_learned_word_weights", with_ctes([], _LEARNED, f"SELECT word, k, {s6('weight')} AS weight FROM wt"))
def q_m05_weights(spark, sf):
    """Shrunk log-odds of every word, from all labels and without each fold's."""
    w = sentiment.word_weights(_labelled_documents(spark, sf), "doc_id", "text", "quality")
    return r6(w.select("word", F.posexplode("weights").alias("k", "weight")), "weight")


@query("M05_learned_sentiment_feature", with_ctes([], _LEARNED + """,
m AS (SELECT doc_id, avg(weight) AS m FROM w JOIN wt ON w.word = wt.word AND w.fold = wt.k GROUP BY doc_id)""",
    f"SELECT t.doc_id, {s6('1 / (1 + exp(-coalesce(m, 0)))')} AS preSentiment FROM t LEFT JOIN m USING (doc_id)"))
def q_m05_learned(spark, sf):
    """Every document's learned sentiment; labelled ones by the other folds' labels."""
    return r6(sentiment.learned_sentiment(_labelled_documents(spark, sf), "doc_id", "text", "quality"), "preSentiment")


def _labelled_documents(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return d.join(read_table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")


# ----------------------------------------------------------------- M06-M17
@query("M01_M02_M06_logit_formula_coefficients_with_se")
def q_m06(spark, sf):
    """Estimates and standard errors; null for the terms that the others determine."""
    train, _ = flight_split(spark, sf)
    return with_constant_terms(glm.fit_formula(train, flight_formula(train)).table(spark), train, FLIGHT_VARS)


_CELLS = """WITH c AS (SELECT count_if(x AND y) AS a, count_if(x AND NOT y) AS b, count_if(NOT x AND y) AS c, count_if(NOT x AND NOT y) AS d
           FROM (SELECT l_returnflag = 'R' AS x, l_discount > 0.05 AS y FROM lineitem))"""


@query("M06_M07_redundant_term_keeps_errors", f"""{_CELLS}
SELECT '(Intercept)' AS term, {s6("ln(c / d)")} AS estimate, {s6("sqrt(1 / c + 1 / d)")} AS std_error FROM c
UNION ALL SELECT 'returned', {s6("ln(a / b) - ln(c / d)")}, {s6("sqrt(1 / a + 1 / b + 1 / c + 1 / d)")} FROM c
UNION ALL SELECT 'again', NULL, NULL""")
def q_m06_redundant(spark, sf):
    """One yes/no predictor, named twice on different scales: its estimates and
    errors have a closed form, and the second name is redundant."""
    li = read_table(spark, sf, "lineitem").select(
        (F.col("l_discount") > 0.05).cast("double").alias("discounted"), (F.col("l_returnflag") == "R").cast("double").alias("returned"))
    fit = glm.fit_formula(li.withColumn("again", 3 - 2 * F.col("returned")), "discounted ~ returned + again")
    return r6(fit.table(spark).select("term", "estimate", "std_error"), "estimate", "std_error")


@query("M07_binomial_glm_five_predictors")
def q_m07(spark, sf):
    f = view(spark, sf, "flights").where(F.col("ArrDel15").isNotNull())
    f = f.withColumn("CRSDepTime", F.floor(F.col("CRSDepTime") / 100).cast("double"))
    vars_ = ["Month", "DayOfMonth", "DayOfWeek", "CRSDepTime", "CRSArrTime"]
    return with_constant_terms(glm.fit_formula(f, flight_formula(f, vars_)).table(spark), f, vars_)


TEXT_SETTING = Setting(l1=1e-5, l2=1e-4)


@query("M08_M09_text_linear_classifier")
def q_m08(spark, sf):
    """Character trigrams without a dictionary limit, fitted on the training
    rows by dual coordinate ascent; area under the curve of both sets."""
    d = smp.tag_rows(text_frame(spark, sf), "doc_id", 3, 1, 1.0, 42)
    fit = tl.fit_text(d, "text", "label", [TEXT_SETTING], [F.col("in_training_set")], tol=1e-2)
    scored = tl.score_text(d, "text", fit, [TEXT_SETTING], ["doc_id", "in_test_set", "label"], key=["doc_id"])
    scored = scored.withColumn("Probability", tl.probability(F.col("margins")[0]))
    return mt.bucketed_auc(scored.withColumn("set", F.when(F.col("in_test_set"), "test").otherwise("training")),
                           "Probability", "label", ["set"])


@query("M09_dual_gap_by_round")
def q_m09_gap(spark, sf):
    """Primal and dual value and their gap after every round, for four penalties
    fitted in the same passes over the labelled texts."""
    settings = [Setting(l1, l2) for l1 in (0.0, 1e-4) for l2 in (1e-3, 1e-2)]
    fit = tl.fit_text(text_frame(spark, sf), "text", "label", settings, tol=1e-3)
    penalties = spark.createDataFrame([(i, s.l1, s.l2) for i, s in enumerate(settings)], "setting int, l1 double, l2 double")
    return fit.history.join(F.broadcast(penalties), "setting")


_RIDGE = 0.1


@query("M09_dual_ascent_ridge_line", f"""
WITH t AS (SELECT CAST(l_quantity AS DOUBLE) / 50 AS x, CAST(l_extendedprice AS DOUBLE) / 1e4 AS y FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(y) AS my, avg(x * x) + {_RIDGE} AS sxx, avg(x * y) AS sxy, 1 + {_RIDGE} AS one FROM t)
SELECT 'quantity' AS term, round((sxy * one - mx * my) / (sxx * one - mx * mx), 3) + 0.0 AS estimate FROM m
UNION ALL SELECT '(Intercept)', round((my * sxx - mx * sxy) / (sxx * one - mx * mx), 3) + 0.0 FROM m""")
def q_m09_ridge(spark, sf):
    """The squared loss with one predictor: the optimum has a closed form."""
    li = read_table(spark, sf, "lineitem")
    rows = li.select((F.col("l_extendedprice").cast("double") / 1e4).alias("y"), F.array(F.lit(True)).alias("uses"),
                     F.array(F.array(F.lit(1).cast("long"))).alias("idx"),
                     F.array(F.array(F.col("l_quantity").cast("double") / 50)).alias("val"))
    fit = dual.ascend(rows, [Setting(0.0, _RIDGE)], "squared", tol=1e-11, passes=2)
    return fit.weights.select(F.when(F.col("feature") == 1, "quantity").otherwise("(Intercept)").alias("term"),
                              F.round("weight", 3).alias("estimate"))


@query("M10_parts_ensemble_boosted_trees")
def q_m10(spark, sf):
    """Sixteen boosted models on disjoint parts, grown in the same passes; the
    mean of their predictions on the test flights."""
    flights = materialize(flight_model_frame(spark, sf).select("ArrDel15", *FLIGHT_VARS), "flights")    # joined once
    train, test = fw.time_split(flights, (2024, 1, 22), (2024, 1, 22), (2024, 2, 1))
    train = smp.disjoint_parts(train, ["Carrier", "DayOfMonth", "CRSArrTime", "OriginAirportID"], 16, 3)
    coded = md.formula_stage(flight_formula(train)).fit(flights)
    model = trees.fit_parts(coded.transform(train), "part", "label", trees=50)
    return trees.predict(model, coded.transform(test), ["ArrDel15", "Carrier", "DayOfMonth"])


@query("M10_ensemble_auc")
def q_m10_auc(spark, sf):
    """AUC of the ensemble's averaged predictions, kept within [0, 1], on the test flights."""
    pred = q_m10(spark, sf).withColumn("Probability", F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)))
    return mt.bucketed_auc(pred.withColumn("model", F.lit("btrees_mean")), "Probability", "ArrDel15", ["model"])


@query("M02_interaction_formula")
def q_m02_interaction(spark, sf):
    """A binomial GLM with an interaction term, fitted over all trips."""
    t = trip_model_frame(spark, sf)
    model = md.fit_logit(t, "tipped ~ passenger_count + trip_distance + passenger_count:trip_distance")
    return md.coefficient_table(spark, model, sample=t)


@query("M11_M12_M13_M14_M15_M16_learners_by_name")
def q_m11(spark, sf):
    # nine learners read both sets many times over: the joins run once, and the sets keep the formula's columns
    train, test = (materialize(d.select("ArrDel15", *FLIGHT_VARS), "flights") for d in flight_split(spark, sf))
    formula = flight_formula(train)
    rows = []
    for name, params in [("linear", {}), ("dtree_reg", {"maxDepth": 5}), ("dtree_class", {"maxDepth": 5}),
                         ("forest_reg", {"numTrees": 20}), ("forest_class", {"numTrees": 20}),
                         ("btrees_reg", {"maxIter": 20}), ("btrees_class", {"maxIter": 20}),
                         ("neuralnet_class", {"layers": None, "maxIter": 50}),
                         ("logistic", {"regParam": 0.01})]:
        if name == "neuralnet_class":
            width = md.vector_width(md.formula_stage(formula).fit(train).transform(train))
            params = {"layers": [width, 8, 2], "maxIter": 50, "seed": 1}
        model = md.fit(train, formula, name, params)
        kind = md.TASK_KIND[name]
        out = sc.score(model, test, ["ArrDel15"], "Score", response=True)
        metric = mt.metric_for(kind)(out, "Score", "ArrDel15")
        rows.append(metric.select(F.lit(name).alias("learner"), F.lit(kind).alias("kind"), "metric"))
    from loam.operators.relational import union_by_name
    return union_by_name(rows)


@query("M17_coefficient_listing")
def q_m17(spark, sf):
    train, _ = flight_split(spark, sf)
    model = md.fit(train, flight_formula(train), "logistic", {"regParam": 0.01})
    return md.coefficient_table(spark, model, sample=train)


# ----------------------------------------------------------------- scoring
def _trip_model(spark, sf):
    t = trip_model_frame(spark, sf)
    train = smp.repeatable_sample(t, ["medallion", "hack_license", "pickup_datetime"], 5, 98052)
    return md.fit_logit(train, TRIP_FORMULA)


@query("E01_batch_score_with_carried_columns")
def q_e01(spark, sf):
    train, test = flight_split(spark, sf)
    model = md.fit_logit(train, flight_formula(train), full=flight_model_frame(spark, sf))
    return sc.score(model, test, ["ArrDel15", "Carrier", "DayOfMonth", "CRSDepTime"], "ArrDel15_Pred")


@query("E02_label_raw_probability")
def q_e02(spark, sf):
    t = trip_model_frame(spark, sf)
    train = smp.repeatable_sample(t, ["medallion", "hack_license", "pickup_datetime"], 5, 98052)
    # the formula, the summary of the columns and the fit read the sample: its rows are joined once
    train = materialize(train.select("tipped", *TRIP_VARS), "trip-sample")
    model = md.fit(train, TRIP_FORMULA, "logistic", {"regParam": 0.0})
    return sc.score_label_raw_prob(model, t, ["o_orderkey", "hack_license", "tipped"])


@query("E03_scores_side_by_side")
def q_e03(spark, sf):
    train, test = flight_split(spark, sf)
    formula = flight_formula(train)
    models = {"logit": md.fit_logit(train, formula, full=flight_model_frame(spark, sf)),
              "forest": md.fit(train, formula, "forest_class", {"numTrees": 20, "seed": 1})}
    return sc.score_many(models, test, ["ArrDel15", "Carrier", "DayOfMonth"])


@query("E12_U05_score_query_rows")
def q_e12(spark, sf):
    model = _trip_model(spark, sf)
    t = trip_model_frame(spark, sf)
    holdout = ("SELECT t.* FROM {trips} t LEFT ANTI JOIN {sample} s ON t.medallion = s.medallion "
               "AND t.hack_license = s.hack_license AND t.pickup_datetime = s.pickup_datetime")
    sample = smp.repeatable_sample(t, ["medallion", "hack_license", "pickup_datetime"], 5, 98052)
    return sc.score_query(spark, model, holdout, ["o_orderkey", "hack_license", "tipped"], trips=t, sample=sample)


def _raw_trip_score(spark, sf):
    """Publish the tip model, load it by name and score one trip from its raw
    inputs (the trip with the smallest key); the distance is derived from the
    coordinates on the way."""
    from loam.plans.registry import ModelRegistry
    reg = ModelRegistry(spark, scratch_path(spark, "registry"))
    reg.save(_trip_model(spark, sf), "tip_logit", "1", modeler="logit")
    raw = ["o_orderkey", "hack_license", "passenger_count", "trip_distance", "trip_time_in_secs", "pickup_latitude",
           "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
    trips = view(spark, sf, "trips").select(*raw)
    row = trips.orderBy(*raw).first()                 # one row: the raw inputs
    return sc.score_single(spark, reg.load("tip_logit"), row.asDict(), trips.schema, derive=lambda d: d.withColumn(
        "direct_distance", haversine_miles("pickup_longitude", "pickup_latitude", "dropoff_longitude",
                                           "dropoff_latitude")), carry=["direct_distance"])


@query("E11_single_row_score_by_model_name")
def q_e11(spark, sf):
    return _raw_trip_score(spark, sf).select("o_orderkey", "passenger_count", "trip_distance", "direct_distance",
                                             "PredictedLabel", "Score", "Probability")


_DIST = haversine_sql("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


def _is_score(c):
    """True where ``c`` is a probability."""
    return F.coalesce(F.col(c).between(0, 1), F.lit(False))


@query("E11_single_row_raw_inputs", with_views(
    "SELECT o_orderkey, hack_license, passenger_count, trip_distance, trip_time_in_secs, "
    f"{s6(_DIST)} AS direct_distance, true AS scored FROM trips ORDER BY o_orderkey, hack_license, passenger_count, "
    "trip_distance, trip_time_in_secs, pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude LIMIT 1",
    "trips"))
def q_e11_inputs(spark, sf):
    out = _raw_trip_score(spark, sf).withColumn("scored", _is_score("Probability"))
    return r6(out.select("o_orderkey", "hack_license", "passenger_count", "trip_distance", "trip_time_in_secs",
                         "direct_distance", "scored"), "direct_distance")


def _with_sentiment(reviews):
    """Reviews with M05's ``preSentiment``, from the row alone."""
    return reviews.withColumn("preSentiment", tx.lexicon_sentiment("review"))


def _review_model(spark, sf):
    """M04 + M05 + M08: word features and the lexicon sentiment, an L2 logistic
    regression fitted on the labelled training paths."""
    from pyspark.ml.feature import VectorAssembler
    r = view(spark, sf, "reviews").where(~F.col("fname").rlike("/unsup/"))
    train, _ = smp.path_split(r.withColumn("label", F.col("fname").rlike("/pos/").cast("double")), "fname", "/train/")
    stages = [*tx.word_feature_stages("review", "words", 1 << 16),
              VectorAssembler(inputCols=["words", "preSentiment"], outputCol="features")]
    # the dictionary and the fit read the rows: views and sentiment are made once
    rows = materialize(_with_sentiment(train), "reviews")
    return md.fit(rows, None, "logistic", {"regParam": 0.01, "elasticNetParam": 0.0}, pre_stages=stages)


@query("E13_U06_parallel_set_scoring")
def q_e13(spark, sf):
    """Score four equal row sets of reviews (H05) in one pass, feature steps
    included, with the fitted review model."""
    r = smp.row_sets(view(spark, sf, "reviews"), 4, ["doc_id"])
    return sc.score_sets(_review_model(spark, sf), _with_sentiment(r), "set_id", ["doc_id", "fname"])


@query("E13_U06_sets_keep_every_row", with_ctes(["reviews"], "", "SELECT doc_id, fname, CAST(ntile(4) OVER "
       "(ORDER BY doc_id) AS INT) AS set_id, true AS scored FROM reviews"))
def q_e13_rows(spark, sf):
    return q_e13(spark, sf).select("doc_id", "fname", F.col("set_id").cast("int").alias("set_id"),
                                   _is_score("Probability").alias("scored"))


@query("E14_scoring_function_stored_levels")
def q_e14(spark, sf):
    train, test = flight_split(spark, sf)
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    # levels stored from the full table; codes become indicator columns
    idx = md.shared_level_indexers(flight_model_frame(spark, sf), ["Carrier", "OriginAirportID"])
    stages = [OneHotEncoder(inputCols=["Carrier_idx", "OriginAirportID_idx"], outputCols=["Carrier_vec", "Origin_vec"]),
              VectorAssembler(inputCols=["Carrier_vec", "Origin_vec", "CRSDepTime", "DayOfWeek"], outputCol="features")]
    data = idx.transform(train).withColumn("label", F.col("ArrDel15").cast("double"))
    model = md.fit(data, None, "logistic", {"regParam": 0.01}, pre_stages=stages)
    scoring = PipelineModel(stages=[*idx.stages, *model.stages])
    return sc.score(scoring, test, ["ArrDel15", "Carrier", "OriginAirportID"], "Score")


@query("S09_scored_output_sink")
def q_s09(spark, sf):
    out = q_e01(spark, sf)
    path = sc.write_scores(out, scratch_path(spark, "scores"))
    return spark.read.parquet(path)


@query("S12_S13_model_registry")
def q_s12(spark, sf):
    from loam.plans.registry import ModelRegistry
    reg = ModelRegistry(spark, scratch_path(spark, "registry"))
    model = _trip_model(spark, sf)
    reg.save(model, "tip_logit", "1", modeler="logit", params={"formula": TRIP_FORMULA})
    try:
        reg.save(model, "tip_logit", "1")
        refused = False
    except ValueError:
        refused = True
    reg.save(model, "tip_logit", "2", modeler="logit")
    reloaded = reg.load("tip_logit", "1")
    n = sc.score(reloaded, trip_model_frame(spark, sf), ["o_orderkey"]).count()
    return reg.table().select("name", "version", "modeler", "path").withColumn(
        "duplicate_refused", F.lit(refused)).withColumn("scored_rows", F.lit(n))


_TRIP_SAMPLE = f"{smp.hash_sql(HOLDOUT_KEYS, 98052)} % 10000 < 500"


@query("E12_U05_holdout_rows_scored", with_views(
    "SELECT t.o_orderkey, t.hack_license, t.tipped, true AS scored FROM trips t WHERE NOT EXISTS (SELECT 1 FROM "
    f"(SELECT * FROM trips WHERE {_TRIP_SAMPLE}) s WHERE s.medallion = t.medallion "
    "AND s.hack_license = t.hack_license AND s.pickup_datetime = t.pickup_datetime)", "trips"))
def q_e12_rows(spark, sf):
    return q_e12(spark, sf).select("o_orderkey", "hack_license", "tipped", _is_score("Score").alias("scored"))


@query("E02_every_row_scored", with_views(
    "SELECT o_orderkey, hack_license, tipped, true AS scored, true AS label_follows FROM trips", "trips"))
def q_e02_rows(spark, sf):
    p, margin = F.col("Probability"), F.col("Score")
    return q_e02(spark, sf).select("o_orderkey", "hack_license", "tipped", _is_score("Probability").alias("scored"),
                                   ((F.col("PredictedLabel") == (p > 0.5)) & (F.abs(p - 1 / (1 + F.exp(-margin))) < 1e-9))
                                   .alias("label_follows"))


@query("S12_S13_registry_rows", with_views(
    "SELECT v.name, v.version, v.modeler, true AS duplicate_refused, (SELECT count(*) FROM trips) AS scored_rows "
    "FROM (VALUES ('tip_logit', '1', 'logit'), ('tip_logit', '2', 'logit')) v(name, version, modeler)", "trips"))
def q_s12_rows(spark, sf):
    return q_s12(spark, sf).drop("path")


@query("N01_stream_score_new_rows")
def q_n01(spark, sf):
    """Publish a model, then score the events table as newly arriving files with
    the newest published version."""
    from loam.plans.registry import ModelRegistry
    from loam.streaming.scoring import follow_registry, read_scores
    ev = read_table(spark, sf, "events")

    def prep(d):
        return d.withColumn("label", F.col("event_type").isin("purchase", "error").cast("double"))
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    for version, reg in (("1", 0.1), ("2", 0.01)):
        registry.save(md.fit(prep(ev), "label ~ value + user_id", "logistic", {"regParam": reg}), "event_logit", version)
    sink = scratch_path(spark, "stream-scores")
    follow_registry(spark, registry, "event_logit", sf, ev.schema, ["event_id", "event_type"], sink,
                    scratch_path(spark, "stream-ckpt"), prepare=prep, glob="events.parquet").awaitTermination()
    return read_scores(spark, sink).drop("batch")


@query("N01_stream_keeps_every_row", "SELECT event_id, event_type, '2' AS model_version, true AS scored FROM events")
def q_n01_rows(spark, sf):
    return q_n01(spark, sf).select("event_id", "event_type", "model_version", _is_score("Probability").alias("scored"))


# ----------------------------------------------------------------- sweeps
def _text_grid(n_docs: int) -> list[dict]:
    fracs = smp.training_fractions(50, max(n_docs * (1 - 1 / 3), 51), 4)
    return [{"model_class": "fastlinear_class", "training_fraction": f, "formula": None, "kfold": 1,
             "feat_ngram": n, "l1_weight": 1e-5, "l2_weight": l2}
            for f in fracs for n in (2, 3) for l2 in (1e-4, 1e-2)]


def _sweep(spark, sf, results_path=None):
    """All settings in shared passes over the labelled texts."""
    data = text_frame(spark, sf)
    return tl.run_linear_grid(spark, data, "doc_id", "text", _text_grid(data.count()), salt=42, results_path=results_path)


@query("E15_parameter_sweep_results")
def q_e15(spark, sf):
    return _sweep(spark, sf)


_LABELLED = "SELECT d.doc_id FROM documents d JOIN labels USING (doc_id)"
_UNIT = smp.hash_sql(["doc_id"], "42:train")


@query("E15_sweep_training_sizes", f"""
WITH l AS ({_LABELLED}), c AS (SELECT ln(50 / greatest(count(*) * (1 - 1e0 / 3), 51)) AS a FROM l),
f AS (SELECT i, exp(a + (0 - a) * i / 3) AS fraction FROM c, range(0, 4) r(i)),
n AS (SELECT i, count(*) AS tss FROM f, l WHERE {smp.hash_sql(["doc_id"], 42)} % 3 + 1 <> 1
      AND {_UNIT} < floor(fraction * 4294967296) GROUP BY i)
SELECT round(fraction, 6) + 0.0 AS fraction, ngram, l2, CAST(tss AS DOUBLE) AS tss, true AS measured
FROM f JOIN n USING (i), (VALUES ('2'), ('3')) g(ngram), (VALUES ('0.0001'), ('0.01')) w(l2)""")
def q_e15_sizes(spark, sf):
    """Every run of the sweep with its exact number of training rows; both areas known."""
    r = _sweep(spark, sf)
    return r.select(F.round(F.get_json_object("run_id", "$[1]").cast("double"), 6).alias("fraction"),
                    F.get_json_object("params", "$.feat_ngram").alias("ngram"), F.regexp_extract("params", r'"l2_weight": ([0-9.]+)', 1).alias("l2"),
                    "tss", F.coalesce(F.col("training").between(0, 1) & F.col("test").between(0, 1), F.lit(False)).alias("measured"))


@query("E16_learning_curve_best_setting")
def q_e16(spark, sf):
    from loam.plans.sweep import best_runs, learning_curve_table
    curve = learning_curve_table(_sweep(spark, sf), r'"feat_ngram": (\d+)', "ngramLength")
    curve = curve.withColumn("l2Weight", F.regexp_extract("params", r'"l2_weight": ([0-9.e-]+)', 1))
    return best_runs(curve, ["ngramLength", "l2Weight", "kfold"])


@query("S15_resume_saved_results")
def q_s15(spark, sf):
    path = scratch_path(spark, "sweep-results")
    first = _sweep(spark, sf, path).count()
    again = _sweep(spark, sf, path)          # every run is already saved: nothing re-executes
    return again.withColumn("runs_after_first_pass", F.lit(first))


@query("E09_metric_by_task_kind")
def q_e09(spark, sf):
    s = view(spark, sf, "scored")
    reg = mt.metric_for("regression")(s, "Probability", "is_real", ["category"]).withColumn("kind", F.lit("regression"))
    cls = mt.metric_for("classification")(s.withColumn("all", F.lit("all")), "Probability", "is_real", ["all"]) \
        .withColumnRenamed("all", "category").withColumn("kind", F.lit("classification"))
    return reg.unionByName(cls)


# ----------------------------------------------------------------- S04 + P03 + M07 pipeline
GLM_COLS = ["IsArrDelayed", "Month", "DayofMonth", "DayOfWeek", "CRSDepTime", "Distance"]


def _lineitem_int_csv(spark, sf) -> str:
    """Integer columns derived from ``lineitem`` written as header CSV (the
    stand-in for the large all-integer flight file)."""
    li = read_table(spark, sf, "lineitem")
    ints = li.select((F.col("l_discount") > 0.05).cast("int").alias("IsArrDelayed"),
                     F.month("l_shipdate").alias("Month"), F.dayofmonth("l_shipdate").alias("DayofMonth"),
                     F.dayofweek("l_shipdate").alias("DayOfWeek"),
                     (F.col("l_linenumber") * 100 + F.col("l_partkey") % 60).cast("int").alias("CRSDepTime"),
                     (F.col("l_quantity") * 20).cast("int").alias("Distance"))
    path = scratch_path(spark, "int-csv")
    ints.write.option("header", True).csv(path)
    return path


@query("M07_S04_P03_csv_to_glm_pipeline")
def q_m07_pipeline(spark, sf):
    """Read the integer CSV (S04), truncate the departure time to the hour
    (P03), fit the five-predictor binomial GLM (M07); returns its coefficients."""
    from loam.sources.files import read_csv_int_matrix
    from loam.operators.relational import floor_to_hour
    df = floor_to_hour(read_csv_int_matrix(spark, _lineitem_int_csv(spark, sf), GLM_COLS), "CRSDepTime")
    return glm.fit_formula(df, "IsArrDelayed ~ Month + DayofMonth + DayOfWeek + CRSDepTime + Distance").table(spark)
