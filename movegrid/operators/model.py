"""Regression on binned features with ``pyspark.ml`` (ML-2..11, AGG-29, PRJ-18/20, ORD-3)."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from movegrid.functions import resolve
from movegrid.functions.scalars import attach_one_row
from movegrid.operators import features as feat
from movegrid.params import FOREST_DEPTH, FOREST_MIN_LEAF, FOREST_TREES, MODEL_SEED, MODEL_TEST_SIZE

# FIXED VALUES - candidate feature names of the track side (intersected with the binned table)
PARITY_CANDIDATES = ["Latitude", "Longitude", "month", "day_of_year", "distance", "speed", "lat_bin", "lon_bin",
                     "sin_month", "cos_month", "sin_day", "cos_day", "log_distance", "log_speed",
                     "lat_centered", "lon_centered"]


FITS = 8               # fits at once
TASK_ROWS = 50_000     # feature rows of a task of a fit; fewer would make every tree level's job all overhead


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """A checkpointed table of ``rows`` feature rows in as many partitions as that many rows need."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def estimator(kind: str, seed: int = MODEL_SEED):
    """ML-5: model-type dispatch; unknown kinds raise."""
    if kind == "random_forest":
        # node ids are cached between levels (checkpointed every 10 levels to the session's
        # checkpoint dir) instead of re-walking every tree for every row at each level
        return RandomForestRegressor(numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, minInstancesPerNode=FOREST_MIN_LEAF,
                                     featureSubsetStrategy="all", seed=seed, labelCol="label",
                                     featuresCol="features", cacheNodeIds=True, checkpointInterval=10)
    if kind == "linear":
        return LinearRegression(regParam=0.0, labelCol="label", featuresCol="features")
    raise ValueError(f"Unknown model type: {kind}")


def stages(kind: str, feats: list[str], seed: int) -> list:
    """Assembler, scaler (fit on the training rows) and estimator; trees need no scaling."""
    if kind == "random_forest":
        return [VectorAssembler(inputCols=feats, outputCol="features"), estimator(kind, seed)]
    return [VectorAssembler(inputCols=feats, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            estimator(kind, seed)]


def feature_columns(binned: DataFrame, target: str = "speed", parity: bool = False) -> list[str]:
    """SEL-9 / D9.  ``parity``: the ordered intersection of the candidate names with the binned
    table (which includes the target).  Default: every numeric binned column except the target
    and the integer keys (bins, positions, distance, plankton and temperature means)."""
    if parity:
        return resolve.intersect_ordered(PARITY_CANDIDATES, binned.columns)
    skip = {target, "lat_key", "lon_key"}
    return [c for c in resolve.numeric_columns(binned, binned.columns) if c not in skip]


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """AGG-29: MSE, RMSE, MAE, R2 as SQL aggregates (R2 = 1 - SSE/SST)."""
    e = F.col(label) - F.col(prediction)
    stats = pred.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.sum(e * e).alias("_sse"),
                     F.var_pop(label).alias("_var"), F.count(F.lit(1)).alias("n"))
    return stats.select("mse", F.sqrt("mse").alias("rmse"), "mae",
                        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("n"))).alias("r2"), "n")


@dataclass
class TrainedModel:
    model: PipelineModel
    features: list[str]
    target: str
    kind: str
    train: DataFrame
    test: DataFrame
    extras: dict = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """ML-9 + PRJ-18: predictions and residuals."""
        out = self.model.transform(df.withColumn("label", F.col(self.target).cast("double")))
        return out.withColumn("residual", F.col("label") - F.col("prediction"))

    def metrics(self) -> DataFrame:
        """ML-6: metrics on the held-out rows."""
        return regression_metrics(self.predict(self.test))

    def importance(self, top: int | None = None) -> DataFrame:
        """ML-8/PRJ-20/ORD-3: (feature, importance) descending; forest only."""
        spark = self.train.sparkSession
        stage = self.model.stages[-1]
        if not hasattr(stage, "featureImportances"):
            return spark.createDataFrame([], "feature string, importance double")
        vals = stage.featureImportances.toArray().tolist()
        df = spark.createDataFrame(list(zip(self.features, [float(v) for v in vals])), "feature string, importance double")
        df = df.orderBy(F.col("importance").desc(), F.col("feature"))
        return df.limit(top) if top else df

    def summary(self) -> DataFrame:
        """ML-11: tidy metric table with sample counts."""
        m = self.metrics()
        counts = self.train.agg(F.count(F.lit(1)).alias("training_samples"))
        return attach_one_row(m, counts).select(F.lit(self.kind).alias("model_type"), "r2", "rmse", "mae",
                         F.lit(len(self.features)).alias("n_features"), "training_samples",
                         F.col("n").alias("test_samples"))


def train(binned: DataFrame, kind: str = "random_forest", target: str = "speed", test_size: float = MODEL_TEST_SIZE,
          seed: int = MODEL_SEED, parity: bool = False, features: list[str] | None = None) -> TrainedModel:
    """ML-1..10: complete cases -> exact hash split -> scale (fit on train) -> fit -> evaluate."""
    feats = features or feature_columns(binned, target, parity)
    data = feat.complete_cases(binned, feats + [target]).withColumn("label", F.col(target).cast("double"))
    parts = feat.split(data, feat.split_order(feat.bin_split_key(), seed), test_size)
    n = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    if not n.get("train"):
        raise ValueError("no complete feature rows to train on")
    train_df, test_df = (gathered(parts.where(F.col("split") == s).drop("split"), n.get(s, 0)) for s in ("train", "test"))
    pipe = Pipeline(stages=stages(kind, feats, seed))
    return TrainedModel(pipe.fit(train_df), feats, target, kind, train_df, test_df)


def cross_validate(tm: TrainedModel, k: int = 5, seed: int = MODEL_SEED) -> DataFrame:
    """ML-7 (D11: on the training rows): R2 per fold with refit; one row per fold.  There are as many
    folds as rows where rows are fewer, and none for a single row, which leaves nothing to fit.

    Fold ids and features are written once; the fits are submitted together, as each level of a tree is a small job that
    leaves most of the cluster idle."""
    n = tm.train.count()
    k = min(k, n)
    if k < 2:
        return tm.train.sparkSession.createDataFrame([], "fold int, r2 double, rmse double, mae double, n long")
    folded = feat.fold(tm.train, feat.split_order(feat.bin_split_key(), seed + 1), k)
    ready = gathered(folded.select(*tm.features, "label", "fold").checkpoint(eager=True), n)

    def one(f: int) -> DataFrame:
        fitted = Pipeline(stages=stages(tm.kind, tm.features, seed)).fit(ready.where(F.col("fold") != f))
        scored = fitted.transform(ready.where(F.col("fold") == f))
        return regression_metrics(scored).select(F.lit(f).alias("fold"), "r2", "rmse", "mae", "n")

    with ThreadPoolExecutor(min(k, FITS)) as pool:
        rows = list(pool.map(inheritable_thread_target(tm.train.sparkSession)(one), range(k)))
    return reduce(DataFrame.unionByName, rows)


def cv_summary(folds: DataFrame) -> DataFrame:
    """ML-7: mean R2 over the folds and twice its (population) standard deviation."""
    return folds.agg(F.count(F.lit(1)).alias("n_folds"), F.avg("r2").alias("r2_mean"), (F.lit(2.0) * F.stddev_pop("r2")).alias("r2_two_std"))
