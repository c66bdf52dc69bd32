"""Binned features, encodings, correlation, split and model queries, and SQL twins."""
from __future__ import annotations

from pyspark.sql import functions as F

from movegrid.functions.scalars import attach_one_row
from movegrid.operators import features as feat
from movegrid.operators import model as mdl
from movegrid.plans import track_queries as tq
from movegrid.plans.common import rounded
from movegrid.sources.standins import grid_points, timed_grid, undated_fixes

CORR_COLUMNS = ["speed", "distance", "Latitude", "Longitude", "acartia_abundance", "calanus_abundance",
                "metridia_abundance", "temperature"]
MODEL_COLUMNS = CORR_COLUMNS
BIN_OUT = ["lat_bin", "lon_bin", "speed", "distance", "Latitude", "Longitude", "acartia_abundance",
           "calanus_abundance", "metridia_abundance", "temperature"]


def binned(spark, sf_dir, impute="median"):
    return feat.bin_join(tq.cleaned(spark, sf_dir), grid_points(spark, sf_dir), impute)


def model_rows(spark, sf_dir):
    return feat.complete_cases(binned(spark, sf_dir), MODEL_COLUMNS)


def q_binned_features(spark, sf_dir):
    b = binned(spark, sf_dir).select(*BIN_OUT)
    return rounded(b, {c: 10 for c in BIN_OUT[2:]})


def q_feature_encodings(spark, sf_dir):
    e = feat.encodings(tq.cleaned(spark, sf_dir))
    r9 = ["sin_month", "cos_month", "sin_day", "cos_day", "log_distance", "log_speed"]
    return rounded(e, {**{c: 9 for c in r9}, "lat_centered": 10, "lon_centered": 10})


def q_aligned_correlation(spark, sf_dir):
    return rounded(feat.correlation(binned(spark, sf_dir, impute=None), CORR_COLUMNS), {"corr": 8})


def q_asof_environment(spark, sf_dir):
    """JN-7: every fix with its bin's abundance and temperature at the latest grid time not after it."""
    out = feat.asof_environment(undated_fixes(spark, sf_dir), timed_grid(spark, sf_dir), ["acartia_abundance", "temperature"])
    return out.select("id", "Date", "row_order", "grid_time", "acartia_abundance", "temperature")


def q_asof_within_days(spark, sf_dir):
    """The same with grid times of at most two days before, counted per day."""
    out = feat.asof_environment(undated_fixes(spark, sf_dir), timed_grid(spark, sf_dir), ["temperature"], tolerance_days=2)
    day = F.date_trunc("DAY", "Date").cast("timestamp_ntz").alias("day")
    return rounded(out.groupBy(day).agg(F.count(F.lit(1)).alias("n_fixes"), F.count("grid_time").alias("n_matched"), F.avg("temperature").alias("temperature")),
                   {"temperature": 6})


def q_split_assignment(spark, sf_dir):
    s = feat.split(model_rows(spark, sf_dir), feat.split_order(feat.bin_split_key(), 42), 0.2)
    return s.select("lat_bin", "lon_bin", "split")


def q_linear_fit_metrics(spark, sf_dir):
    """AGG-29 of a one-feature least squares fit: the fit is attached once, then one aggregate."""
    rows = model_rows(spark, sf_dir).select("speed", "distance")
    fit = rows.agg(F.regr_slope("speed", "distance").alias("slope"), F.regr_intercept("speed", "distance").alias("intercept"))
    e = F.col("speed") - (F.col("intercept") + F.col("slope") * F.col("distance"))
    sums = attach_one_row(rows, fit).agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("sse"), F.var_pop("speed").alias("var"),
        F.count(F.lit(1)).alias("n"), F.max("slope").alias("slope"), F.max("intercept").alias("intercept"))
    out = sums.select("mse", F.sqrt("mse").alias("rmse"), "mae", (F.lit(1.0) - F.try_divide("sse", F.col("var") * F.col("n"))).alias("r2"),
                      "n", "slope", "intercept")
    return rounded(out, {"mse": 8, "rmse": 8, "mae": 8, "r2": 8, "slope": 8, "intercept": 8})


def _forest(spark, sf_dir, parity=False):
    return mdl.train(binned(spark, sf_dir), "random_forest", parity=parity)


def _facts(tm, least_r2):
    """What a random fit must satisfy whatever its seed: sizes, and metrics that agree with each
    other and lie in stated bounds (R2 at least ``least_r2``, on held-out rows)."""
    return tm.summary().select("model_type", "n_features", "training_samples", "test_samples",
                               ((F.col("r2") <= 1) & (F.col("r2") >= least_r2)).alias("r2_in_bounds"),
                               ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse"))).alias("errors_agree"))


def q_model_metrics(spark, sf_dir):
    """ML-3/6/11: the forest's sizes, and its held-out metrics within bounds."""
    return _facts(_forest(spark, sf_dir), -0.5)


def q_model_metrics_parity(spark, sf_dir):
    """D9: with the target among the features the held-out R2 is close to 1."""
    return _facts(_forest(spark, sf_dir, parity=True), 0.8)


def q_model_linear(spark, sf_dir):
    """ML-2/4 with all features: least squares residuals sum to zero and are orthogonal to every
    feature on the training rows."""
    tm = mdl.train(binned(spark, sf_dir), "linear")
    pred = tm.predict(tm.train)
    products = [F.round(F.covar_pop("residual", c), 6).alias(f"c{i}") for i, c in enumerate(tm.features)]
    one = pred.agg(F.count(F.lit(1)).alias("training_samples"), F.round(F.avg("residual"), 6).alias("mean"), *products)
    worst = F.greatest(*[F.abs(f"c{i}") for i in range(len(tm.features))])
    return one.select(F.lit(len(tm.features)).alias("n_features"), "training_samples", (F.abs("mean") + F.lit(0.0)).alias("residual_mean"),
                      worst.alias("residual_covariance"))


def q_model_importance(spark, sf_dir):
    """ML-8/PRJ-20/ORD-3: every feature once, importances non-negative, in order, summing to 1."""
    imp = _forest(spark, sf_dir).importance()
    total = imp.agg(F.sum("importance").alias("total"))
    return attach_one_row(imp, total).select("feature", (F.col("importance") >= 0).alias("not_negative"), F.round("total", 6).alias("total"))


def q_model_predictions(spark, sf_dir):
    """ML-9 + PRJ-18: predictions and residuals of the held-out rows by the one-feature linear model."""
    tm = mdl.train(model_rows(spark, sf_dir), "linear", features=["distance"])
    out = tm.predict(tm.test).select("lat_bin", "lon_bin", "label", "prediction", "residual")
    return rounded(out, {"label": 8, "prediction": 6, "residual": 6})


def q_model_forest_predictions(spark, sf_dir):
    """ML-9: the forest scores every held-out row once; residual = label - prediction."""
    tm = _forest(spark, sf_dir)
    sure = F.abs(F.col("residual") - (F.col("label") - F.col("prediction"))) < 1e-12
    return tm.predict(tm.test).select("lat_bin", "lon_bin", F.round("label", 8).alias("label"), sure.alias("residual_holds"))


def q_model_linear_fit(spark, sf_dir):
    """ML-1..6 end to end with one feature: exact split, scaler, OLS fit, test metrics.

    Ordinary least squares is exact, so the metrics equal the closed form in SQL."""
    tm = mdl.train(model_rows(spark, sf_dir), "linear", features=["distance"])
    m = tm.metrics()
    return rounded(m, {"mse": 6, "rmse": 6, "mae": 6, "r2": 6})


def _cv(spark, sf_dir):
    return mdl.cross_validate(mdl.train(model_rows(spark, sf_dir), "linear", features=["distance"]), 5)


def q_model_cv(spark, sf_dir):
    """ML-7: R2, RMSE and MAE per fold of the one-feature linear model, refitted for each."""
    return rounded(_cv(spark, sf_dir), {"r2": 5, "rmse": 6, "mae": 6})


def q_model_cv_summary(spark, sf_dir):
    """ML-7: mean R2 and twice its standard deviation."""
    return rounded(mdl.cv_summary(_cv(spark, sf_dir)), {"r2_mean": 5, "r2_two_std": 5})


def _forest_cv(spark, sf_dir):
    return mdl.cross_validate(_forest(spark, sf_dir), 5)


def q_model_forest_cv(spark, sf_dir):
    """ML-7: the forest with all features, refitted for each fold: rows per fold, and metrics within
    bounds (folds may hold a dozen rows).  ``pipeline.run`` returns the metrics themselves."""
    return _forest_cv(spark, sf_dir).select("fold", "n", ((F.col("r2") <= 1) & (F.col("r2") >= -1.5)).alias("r2_in_bounds"),
                                            ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse"))).alias("errors_agree"))


def q_model_forest_cv_summary(spark, sf_dir):
    """ML-7: the forest's mean R2 and twice its standard deviation, within bounds."""
    return mdl.cv_summary(_forest_cv(spark, sf_dir)).select("n_folds", ((F.col("r2_mean") <= 1) & (F.col("r2_mean") >= -1)).alias("mean_in_bounds"),
                                                            ((F.col("r2_two_std") >= 0) & (F.col("r2_two_std") <= 2.5)).alias("std_in_bounds"))


def q_model_forest_report(spark, sf_dir):
    """ML-6/8/11, PRJ-20: the forest's metrics on held-out rows and every feature's importance, as (section, name, value).
    A forest's numbers are beyond SQL: tests hold them against its predictions and against bounds."""
    tm = _forest(spark, sf_dir)
    m = tm.summary()
    names = [c for c in m.columns if c != "model_type"]
    metrics = m.select(F.inline(F.array(*[F.struct(F.lit("metric").alias("section"), F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names])))
    return metrics.unionByName(tm.importance().select(F.lit("importance").alias("section"), F.col("feature").alias("name"), F.col("importance").alias("value")))


def q_model_forest_scored(spark, sf_dir):
    """ML-9 + PRJ-18: label, prediction and residual of every held-out row by the forest."""
    tm = _forest(spark, sf_dir)
    return tm.predict(tm.test).select("lat_bin", "lon_bin", "label", "prediction", "residual")


def q_model_forest_folds(spark, sf_dir):
    """ML-7: the forest's R2, RMSE and MAE per fold."""
    return _forest_cv(spark, sf_dir)


QUERIES = {
    "binned_features": q_binned_features,
    "feature_encodings": q_feature_encodings,
    "aligned_correlation": q_aligned_correlation,
    "asof_environment": q_asof_environment,
    "asof_within_days": q_asof_within_days,
    "split_assignment": q_split_assignment,
    "linear_fit_metrics": q_linear_fit_metrics,
    "model_metrics": q_model_metrics,
    "model_metrics_parity": q_model_metrics_parity,
    "model_linear": q_model_linear,
    "model_importance": q_model_importance,
    "model_predictions": q_model_predictions,
    "model_forest_predictions": q_model_forest_predictions,
    "model_cv": q_model_cv,
    "model_cv_summary": q_model_cv_summary,
    "model_linear_fit": q_model_linear_fit,
    "model_forest_report": q_model_forest_report,
    "model_forest_scored": q_model_forest_scored,
    "model_forest_folds": q_model_forest_folds,
    "model_forest_cv": q_model_forest_cv,
    "model_forest_cv_summary": q_model_forest_cv_summary,
}

# ---------------------------------------------------------------------------------------------
from movegrid.plans.grid_queries import GRID_CTES  # noqa: E402
from movegrid.plans.track_queries import TRACK_CTES  # noqa: E402

_ABUND = ["acartia_abundance", "calanus_abundance", "metridia_abundance"]

FEATURE_CTES = TRACK_CTES.strip() + ",\n" + GRID_CTES.strip() + """,
tb AS (
  SELECT CAST(round_even(Latitude * 10, 0) AS BIGINT) AS lat_key, CAST(round_even(Longitude * 10, 0) AS BIGINT) AS lon_key,
         avg(speed) AS speed, avg(distance) AS distance, avg(Latitude) AS Latitude, avg(Longitude) AS Longitude
  FROM cl GROUP BY 1, 2),
gb AS (
  SELECT CAST(round_even(latitude * 10, 0) AS BIGINT) AS lat_key, CAST(round_even(longitude * 10, 0) AS BIGINT) AS lon_key,
         avg(acartia_abundance) AS acartia_abundance, avg(calanus_abundance) AS calanus_abundance,
         avg(metridia_abundance) AS metridia_abundance, avg(temperature) AS temperature
  FROM gp GROUP BY 1, 2),
bj AS (
  SELECT tb.*, gb.acartia_abundance, gb.calanus_abundance, gb.metridia_abundance, gb.temperature,
         tb.lat_key / CAST(10 AS DOUBLE) AS lat_bin, tb.lon_key / CAST(10 AS DOUBLE) AS lon_bin
  FROM tb LEFT JOIN gb ON tb.lat_key = gb.lat_key AND tb.lon_key = gb.lon_key),
bf AS (
  SELECT lat_key, lon_key, lat_bin, lon_bin, speed, distance, Latitude, Longitude,
         coalesce(acartia_abundance, median(acartia_abundance) OVER ()) AS acartia_abundance,
         coalesce(calanus_abundance, median(calanus_abundance) OVER ()) AS calanus_abundance,
         coalesce(metridia_abundance, median(metridia_abundance) OVER ()) AS metridia_abundance,
         temperature
  FROM bj),
mr AS (
  SELECT * FROM bf WHERE speed IS NOT NULL AND distance IS NOT NULL AND Latitude IS NOT NULL AND Longitude IS NOT NULL
    AND acartia_abundance IS NOT NULL AND calanus_abundance IS NOT NULL AND metridia_abundance IS NOT NULL
    AND temperature IS NOT NULL)
"""


def _sql(body: str) -> str:
    return "WITH " + FEATURE_CTES.strip() + "\n" + body


def _corr_sql() -> str:
    from itertools import combinations
    parts = []
    for a, b in [(b, a) for a, b in combinations(CORR_COLUMNS, 2)]:
        xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END"
        xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END"
        parts.append(f"SELECT '{a}' AS var_a, '{b}' AS var_b, "
                     f"round(covar_samp({xa}, {xb}) / NULLIF(stddev_samp({xa}) * stddev_samp({xb}), 0), 8) AS corr, "
                     f"count({xa}) AS n FROM bj")
    return "\nUNION ALL\n".join(parts)


_order = "(CAST(k AS HUGEINT) * 2654435761 + {seed}) % 4294967296, k"
_SPLIT = f"""
, sp AS (
  SELECT *, row_number() OVER (ORDER BY {_order.format(seed=42)}) - 1 < ceil(0.2 * count(*) OVER ()) AS is_test
  FROM (SELECT *, (lat_key + 900) * 10000 + (lon_key + 1800) AS k FROM mr))"""
_CV = _SPLIT + f""",
fo AS (SELECT *, (row_number() OVER (ORDER BY {_order.format(seed=43)}) - 1) % 5 AS fold FROM sp WHERE NOT is_test),
ft AS (SELECT g.fold, regr_slope(speed, distance) AS slope, regr_intercept(speed, distance) AS intercept
       FROM (SELECT DISTINCT fold FROM fo) g JOIN fo ON fo.fold <> g.fold GROUP BY g.fold),
pr AS (SELECT fo.fold, speed AS label, speed - (intercept + slope * distance) AS e FROM fo JOIN ft ON fo.fold = ft.fold),
cv AS (SELECT CAST(fold AS INTEGER) AS fold, 1 - sum(e * e) / nullif(var_pop(label) * count(*), 0) AS r2, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, count(*) AS n
       FROM pr GROUP BY fold)"""
_ASOF = """,
fx AS (
  SELECT *, CAST(round_even(Latitude * 10, 0) AS BIGINT) AS lat_key, CAST(round_even(Longitude * 10, 0) AS BIGINT) AS lon_key
  FROM (SELECT * REPLACE (CASE WHEN row_order % 31 <> 0 THEN "Date" END AS "Date", CASE WHEN row_order % 37 <> 0 THEN Latitude END AS Latitude) FROM tp)),
tg AS (
  SELECT CAST(round_even(latitude * 10, 0) AS BIGINT) AS lat_key, CAST(round_even(longitude * 10, 0) AS BIGINT) AS lon_key,
         TIMESTAMP '2024-01-01' + to_hours(row_order % 690) AS time, acartia_abundance, temperature, row_order * 100000 + row_tiebreak AS o
  FROM gp WHERE row_order % 29 <> 0),
g1 AS (
  SELECT lat_key, lon_key, time, arg_max(acartia_abundance, o) AS acartia_abundance, arg_max(temperature, o) AS temperature
  FROM tg GROUP BY ALL)
"""
# FIXED VALUES - features of the binned table, and those of the candidate list that it has (D9)
MODEL_FEATURES = ["distance", "Latitude", "Longitude", "acartia_abundance", "calanus_abundance", "metridia_abundance", "temperature", "lat_bin", "lon_bin"]
N_PARITY = 6

_bin_cols = ", ".join(["lat_bin", "lon_bin"] + [f"round({c}, 10) AS {c}" for c in BIN_OUT[2:]])

_sizes = "CAST(count(*) FILTER (NOT is_test) AS BIGINT) AS training_samples, CAST(count(*) FILTER (is_test) AS BIGINT) AS test_samples"
ORACLE = {
    "model_metrics": _sql(_SPLIT + f"SELECT 'random_forest' AS model_type, {len(MODEL_FEATURES)} AS n_features, {_sizes}, true AS r2_in_bounds, true AS errors_agree FROM sp"),
    "model_metrics_parity": _sql(_SPLIT.replace("FROM mr)", "FROM tb)") + f"SELECT 'random_forest' AS model_type, {N_PARITY} AS n_features, {_sizes}, true AS r2_in_bounds, true AS errors_agree FROM sp"),
    "model_linear": _sql(_SPLIT + f"SELECT {len(MODEL_FEATURES)} AS n_features, count(*) AS training_samples, CAST(0 AS DOUBLE) AS residual_mean, CAST(0 AS DOUBLE) AS residual_covariance FROM sp WHERE NOT is_test"),
    "model_importance": f"SELECT unnest({MODEL_FEATURES}) AS feature, true AS not_negative, CAST(1 AS DOUBLE) AS total",
    "model_predictions": _sql(_SPLIT + """,
fit AS (SELECT regr_slope(speed, distance) AS slope, regr_intercept(speed, distance) AS intercept FROM sp WHERE NOT is_test)
SELECT lat_bin, lon_bin, round(speed, 8) AS label, round(intercept + slope * distance, 6) AS prediction,
       round(speed - (intercept + slope * distance), 6) AS residual
FROM sp, fit WHERE is_test"""),
    "model_forest_predictions": _sql(_SPLIT + "SELECT lat_bin, lon_bin, round(speed, 8) AS label, true AS residual_holds FROM sp WHERE is_test"),
    "model_cv": _sql(_CV + "SELECT fold, round(r2, 5) AS r2, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n FROM cv"),
    "model_cv_summary": _sql(_CV + "SELECT count(*) AS n_folds, round(avg(r2), 5) AS r2_mean, round(2 * stddev_pop(r2), 5) AS r2_two_std FROM cv"),
    "model_forest_cv": _sql(_CV + "SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, true AS r2_in_bounds, true AS errors_agree FROM fo GROUP BY fold"),
    "model_forest_cv_summary": _sql(_CV + "SELECT count(DISTINCT fold) AS n_folds, true AS mean_in_bounds, true AS std_in_bounds FROM fo"),
    "binned_features": _sql(f"SELECT {_bin_cols} FROM bf"),
    "feature_encodings": _sql("""
SELECT Latitude, Longitude, month, CAST(dayofyear("Date") AS INTEGER) AS day_of_year, distance, speed, lat_bin, lon_bin,
       round(sin(2 * pi() * month / 12), 9) AS sin_month, round(cos(2 * pi() * month / 12), 9) AS cos_month,
       round(sin(2 * pi() * dayofyear("Date") / 365), 9) AS sin_day, round(cos(2 * pi() * dayofyear("Date") / 365), 9) AS cos_day,
       round(ln(1 + distance), 9) AS log_distance, round(ln(1 + speed), 9) AS log_speed,
       round(Latitude - avg(Latitude) OVER (), 10) AS lat_centered, round(Longitude - avg(Longitude) OVER (), 10) AS lon_centered
FROM cl"""),
    "aligned_correlation": _sql(_corr_sql()),
    "asof_environment": _sql(_ASOF + """
SELECT f.id, f."Date", f.row_order, g.time AS grid_time, g.acartia_abundance, g.temperature
FROM fx f ASOF LEFT JOIN g1 g ON f.lat_key = g.lat_key AND f.lon_key = g.lon_key AND f."Date" >= g.time"""),
    "asof_within_days": _sql(_ASOF + """,
m AS (
  SELECT f."Date", CASE WHEN f."Date" - g.time <= INTERVAL 2 DAY THEN g.time END AS grid_time, g.temperature
  FROM fx f ASOF LEFT JOIN g1 g ON f.lat_key = g.lat_key AND f.lon_key = g.lon_key AND f."Date" >= g.time)
SELECT CAST(date_trunc('day', "Date") AS TIMESTAMP) AS day, count(*) AS n_fixes, count(grid_time) AS n_matched,
       round(avg(CASE WHEN grid_time IS NOT NULL THEN temperature END), 6) AS temperature
FROM m GROUP BY 1"""),
    "split_assignment": _sql("""
SELECT lat_bin, lon_bin,
       CASE WHEN row_number() OVER (ORDER BY (CAST(k AS HUGEINT) * 2654435761 + 42) % 4294967296, k) - 1 < ceil(0.2 * count(*) OVER ())
            THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, (lat_key + 900) * 10000 + (lon_key + 1800) AS k FROM mr)"""),
    "model_linear_fit": _sql("""
, sp AS (
  SELECT *, row_number() OVER (ORDER BY (CAST(k AS HUGEINT) * 2654435761 + 42) % 4294967296, k) - 1
              < ceil(0.2 * count(*) OVER ()) AS is_test
  FROM (SELECT *, (lat_key + 900) * 10000 + (lon_key + 1800) AS k FROM mr)),
fit AS (SELECT regr_slope(speed, distance) AS slope, regr_intercept(speed, distance) AS intercept FROM sp WHERE NOT is_test),
pr AS (SELECT speed AS label, intercept + slope * distance AS prediction FROM sp, fit WHERE is_test),
st AS (SELECT avg((label - prediction) * (label - prediction)) AS mse, avg(abs(label - prediction)) AS mae,
              sum((label - prediction) * (label - prediction)) AS sse, var_pop(label) AS v, count(*) AS n FROM pr)
SELECT round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae, round(1 - sse / NULLIF(v * n, 0), 6) AS r2, n
FROM st"""),
    "linear_fit_metrics": _sql("""
, fit AS (SELECT regr_slope(speed, distance) AS slope, regr_intercept(speed, distance) AS intercept FROM mr),
pr AS (SELECT speed AS label, intercept + slope * distance AS prediction FROM mr, fit),
st AS (SELECT avg((label - prediction) * (label - prediction)) AS mse, avg(abs(label - prediction)) AS mae,
              sum((label - prediction) * (label - prediction)) AS sse, var_pop(label) AS v, count(*) AS n FROM pr)
SELECT round(mse, 8) AS mse, round(sqrt(mse), 8) AS rmse, round(mae, 8) AS mae, round(1 - sse / NULLIF(v * n, 0), 8) AS r2,
       n, round(slope, 8) AS slope, round(intercept, 8) AS intercept
FROM st, fit"""),
}
