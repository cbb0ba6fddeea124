"""The cell risk model on pyspark.ml: split, search, fit, gates, scoring, promotion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import rolling
from tessera.operators.joining import scalar, settle
from tessera.session import scratch_dir

INPUTS = [
    "hour_bucket", "weighted_score_3d", "weighted_score_30d", "weighted_score_90d", "trend_3v10", "trend_10v30",
    "trend_30v90", "gun_incident_count_30d", "high_severity_ratio_30d", "night_score_ratio", "evening_score_ratio",
    "weekend_score_ratio", "neighbor_weighted_score_30d", "neighbor_trend_3v10", "neighbor_gun_count_30d",
    "cell_score_yesterday",
]


@dataclass(frozen=True)
class ModelConfig:
    inputs: Sequence[str] = tuple(INPUTS)
    target: str = "danger_rate"
    trees: int = 20
    depth: int = 5
    step: float = 0.1
    rmse_gate: float = 0.5
    ratio_gate: float = 2.0
    #: Which over-fit ratio the gate looks at: "train/val", "val/train" or "both".
    ratio: str = "train/val"
    #: Inputs with at most this many distinct values are split as categories; the hour bucket has six.
    categories: int = 8
    min_cells: int = 500
    min_rows: int = 100
    slice_dimensions: Sequence[str] = ("district", "hour_bucket")
    max_slice_deviation: float = 0.5
    min_slice_size: int = 30
    max_slice_multiple: float = 3.0
    tolerance: float = 0.0
    force_promote: bool = False
    grid: Mapping[str, Sequence] = field(default_factory=lambda: {"maxDepth": (3, 5), "stepSize": (0.05, 0.1)})


def _split_key(df: DataFrame) -> DataFrame:
    return df.withColumn("_key", F.pmod(F.xxhash64("h3_index", "hour_bucket"), F.lit(2147483647)))


def random_split(df: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and validation rows by key hash."""
    from tessera.operators.sampling import hash_split

    s = hash_split(_split_key(df), "_key", percent).drop("_key")
    return s.where("split = 'train'").drop("split"), s.where("split = 'validation'").drop("split")


def regressor(cfg: ModelConfig) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol=cfg.target, predictionCol="raw_prediction", lossType="absolute",
        maxIter=cfg.trees, maxDepth=cfg.depth, stepSize=cfg.step, seed=42,
    )


def fit(train: DataFrame, cfg: ModelConfig) -> PipelineModel:
    """Boosted trees on absolute loss over the configured inputs."""
    return Pipeline(stages=[*inputs(cfg), regressor(cfg)]).fit(train)


def inputs(cfg: ModelConfig) -> list:
    """Inputs as one vector, with the hour bucket as a category rather than a number."""
    names = [c for c in cfg.inputs if c != "hour_bucket"]
    if len(names) == len(cfg.inputs):
        return [VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")]
    bucket = VectorAssembler(inputCols=["hour_bucket"], outputCol="_bucket", handleInvalid="keep")
    nominal = VectorIndexer(inputCol="_bucket", outputCol="_nominal", maxCategories=cfg.categories, handleInvalid="keep")
    return [bucket, nominal, VectorAssembler(inputCols=["_nominal", *names], outputCol="features", handleInvalid="keep")]


def search(train: DataFrame, cfg: ModelConfig, parallelism: int = 2) -> dict:
    """Grid search on validation RMSE; the parameters of the best setting."""
    gbt = regressor(cfg)
    grid = ParamGridBuilder()
    for name, values in cfg.grid.items():
        grid = grid.addGrid(gbt.getParam(name), list(values))
    rows = Pipeline(stages=inputs(cfg)).fit(train).transform(train)
    evaluator = RegressionEvaluator(labelCol=cfg.target, predictionCol="raw_prediction", metricName="rmse")
    tvs = TrainValidationSplit(
        estimator=gbt, estimatorParamMaps=grid.build(), evaluator=evaluator, trainRatio=0.8, parallelism=parallelism, seed=42
    )
    best = tvs.fit(rows).bestModel
    return {name: best.getOrDefault(name) for name in cfg.grid}


def predict(model: PipelineModel, df: DataFrame, out: str = "predicted_danger") -> DataFrame:
    """Predictions with a floor of zero."""
    return model.transform(df).withColumn(out, F.greatest("raw_prediction", F.lit(0.0))).drop("raw_prediction", "features", "_bucket", "_nominal")


def rmse(df: DataFrame, truth: str, predicted: str) -> float:
    return df.agg(F.sqrt(F.avg(F.pow(F.col(truth) - F.col(predicted), 2)))).first()[0]


def error_gate(train: DataFrame, val: DataFrame, truth: str, predicted: str, cfg: ModelConfig) -> DataFrame:
    """RMSE, both over-fit ratios and the cell count, and whether all limits hold, one row. ``cfg.ratio`` picks the ratio."""
    looked_at = {"train/val": ["train_over_val"], "val/train": ["val_over_train"], "both": ["train_over_val", "val_over_train"]}[cfg.ratio]
    err = F.sqrt(F.avg(F.pow(F.col(truth) - F.col(predicted), 2)))
    out = val.agg(err.alias("rmse_val"), F.count_distinct("h3_index").alias("cells"))
    out = out.withColumn("rmse_train", scalar(train, err))
    out = out.withColumns(
        {
            "train_over_val": numbers.ratio("rmse_train", "rmse_val", 0.0),
            "val_over_train": numbers.ratio("rmse_val", "rmse_train", 0.0),
        }
    )
    return out.withColumn(
        "passed",
        (F.col("rmse_val") <= cfg.rmse_gate) & (F.greatest(*map(F.col, looked_at), F.lit(0.0)) <= cfg.ratio_gate) & (F.col("cells") >= cfg.min_cells),
    )


def importance(spark, model: PipelineModel, cfg: ModelConfig) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray().tolist()
    names = sorted(cfg.inputs, key=lambda c: c != "hour_bucket")  # the order of ``inputs``
    rows = sorted(zip(names, weights), key=lambda r: -r[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def score_table(
    predictions: DataFrame, version: str, scored_at: str, per_bucket: bool = True, value="predicted_danger"
) -> DataFrame:
    """Scaled scores with tier and version stamps."""
    scored = rolling.risk_scores(predictions, value, per_bucket)
    return scored.select(
        "h3_index", "hour_bucket", value, "risk_score", numbers.risk_tier("risk_score").alias("risk_tier"),
        F.lit(version).alias("model_version"), F.lit(scored_at).alias("scored_at"),
    )


# -- version table -----------------------------------------------------------------------------


def production(versions: DataFrame) -> DataFrame:
    """The production row: newest version in that stage."""
    return versions.where("stage = 'production'").orderBy(F.desc("version")).limit(1)


def compare_to_production(candidates: DataFrame, versions: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Promote when not worse than production by more than the tolerance, or when there is none."""
    prod = production(versions)
    p, v = scalar(prod, F.first("val_rmse")), scalar(prod, F.first("version"))
    c = candidates.withColumns({"production_version": v, "production_rmse": p})
    return c.withColumns(
        {
            "delta_pct": (F.col("val_rmse") - F.col("production_rmse")) / F.col("production_rmse") * 100,
            "should_promote": F.col("production_rmse").isNull()
            | (F.col("val_rmse") <= F.col("production_rmse") * (1 + tolerance)),
        }
    )


def rollback(versions: DataFrame, version: str) -> DataFrame:
    """Stage table with the given version in production and the former one archived."""
    stage = (
        F.when(F.col("version") == version, "production")
        .when(F.col("stage") == "production", "archived")
        .otherwise(F.col("stage"))
    )
    return versions.withColumn("stage", stage)


# -- whole run ---------------------------------------------------------------------------------


@dataclass
class TrainingRun:
    model: PipelineModel | None
    scores: DataFrame | None
    metrics: dict
    promoted: bool
    stopped_at: str | None = None


def train_run(
    features: DataFrame, incidents: DataFrame, cfg: ModelConfig, version: str, scored_at: str,
    versions: DataFrame | None = None, tune: bool = False,
) -> TrainingRun:
    """Load → label → split → (search) → fit → error gate → slice gate → promotion → scores. A gate
    that fails ends the run before anything is published."""
    from tessera.operators import fairness, features as feats

    matrix = settle(feats.training_matrix(features, incidents, cfg.target))
    rows = matrix.count()
    if rows < cfg.min_rows:
        return TrainingRun(None, None, {"rows": rows}, False, "too few rows")
    train, val = random_split(matrix)
    if tune:
        found = search(train, cfg)
        cfg = ModelConfig(**{**cfg.__dict__, "depth": found.get("maxDepth", cfg.depth), "step": found.get("stepSize", cfg.step)})
    model = fit(train, cfg)
    train_p, val_p = predict(model, train), predict(model, val)
    gate = error_gate(train_p, val_p, cfg.target, "predicted_danger", cfg).first()
    metrics = {"rows": rows, **gate.asDict()}
    if not gate.passed:
        return TrainingRun(model, None, metrics, False, "error gate")
    dims = [d for d in cfg.slice_dimensions if d in val_p.columns]
    slices = fairness.slice_gate(
        val_p, dims, cfg.target, "predicted_danger", cfg.max_slice_deviation, cfg.min_slice_size, cfg.max_slice_multiple
    )
    worst = fairness.gate_summary(slices).first()
    metrics["worst_slice"] = worst.worst_slice
    if worst.failed:
        return TrainingRun(model, None, metrics, False, "slice gate")
    if versions is not None and not cfg.force_promote:
        cand = features.sparkSession.createDataFrame([(version, float(gate.rmse_val))], "candidate string, val_rmse double")
        if not compare_to_production(cand, versions, cfg.tolerance).first().should_promote:
            return TrainingRun(model, None, metrics, False, "promotion")
    scores = score_table(predict(model, features), version, scored_at)
    return TrainingRun(model, scores, metrics, True)




def classifier(
    train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str, kind: str = "forest"
) -> PipelineModel:
    """Classifier over label-encoded and numeric columns, for group audits.

    It is written and read again, which leaves its training summary behind: that holds the session, goes to the tasks with the
    model, and can't any more once something was observed in the session.
    """
    index = StringIndexer(
        inputCols=list(categorical), outputCols=[f"{c}_code" for c in categorical], stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    assemble = VectorAssembler(inputCols=[*[f"{c}_code" for c in categorical], *numeric], outputCol="features", handleInvalid="keep")
    learner = (
        RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=5, seed=42, maxBins=256)
        if kind == "forest"
        else LogisticRegression(labelCol=label, maxIter=50)
    )
    path = scratch_dir(train.sparkSession, "classifier")
    Pipeline(stages=[index, assemble, learner]).fit(train).save(path)
    return PipelineModel.load(path)
