"""Models on pyspark.ml: price regression with grid search, tier classifiers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IDF, CountVectorizer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numbers import round2
from ..functions.text import split_tokens
from ..schemas import CATEGORICAL_FEATURES, PREDICTION_COLUMNS, TIER_NUMERIC_FEATURES, TRAIN_NUMERIC_FEATURES
from ..session import checkpoint_root, stored
from .features import MAX_TOKENS, ColumnTransform, ColumnTransformModel, label_decode, label_encoder
from .filters import project_existing
from .splits import contiguous_folds

# Model seed and the searched grid.
SEED = 23002
PARAM_GRID = {
    "n_estimators": [200, 300],
    "max_depth": [5, 7],
    "learning_rate": [0.05, 0.1],
    "min_samples_leaf": [5, 10],
}
GBT_PARAMS = {
    "n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize",
    "min_samples_leaf": "minInstancesPerNode",
}


def gbt_regressor(label: str = "price_num", features: str = "features", prediction: str = "prediction",
                  seed: int = SEED, **params) -> GBTRegressor:
    """Squared-loss boosted trees; parameters by the names of the grid."""
    chosen = {GBT_PARAMS[k]: v for k, v in params.items()}
    return GBTRegressor(labelCol=label, featuresCol=features, predictionCol=prediction, seed=seed, **chosen)


def price_pipeline(numeric: Sequence[str] = tuple(TRAIN_NUMERIC_FEATURES),
                   categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
                   label: str = "price_num", **params) -> Pipeline:
    return Pipeline(stages=[ColumnTransform(numeric, categorical), gbt_regressor(label, **params)])


def boost(gbt: GBTRegressor, rows: DataFrame, point: dict) -> GBTRegressionModel:
    """One boosting run of the search."""
    return gbt.fit(rows, point)


def grid_search(
    train: DataFrame, order: Sequence[str], numeric: Sequence[str] = tuple(TRAIN_NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES), label: str = "price_num",
    grid: dict[str, list] = PARAM_GRID, folds: int = 3, parallelism: int = 4,
) -> CrossValidatorModel:
    """Every grid point on unshuffled folds over the table order, scored by MAE, best one refitted.

    The preparation is fitted once per fold, and once for the refit, and its vectors are stored;
    grid points fit trees only. Points that differ in the number of trees share one boosting run: its
    first trees are the smaller model, and one pass scores every prefix.
    """
    checkpoint_root(train.sparkSession)  # boosting cuts its lineage there
    pipeline = price_pipeline(numeric, categorical, label)
    gbt = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(gbt.getParam(GBT_PARAMS[name]), values)
    points = builder.build()
    trees = [p.get(gbt.maxIter, gbt.getMaxIter()) for p in points]
    runs: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        runs.setdefault(tuple(sorted((p.name, v) for p, v in point.items() if p != gbt.maxIter)), []).append(i)
    folded = contiguous_folds(train, order, folds, "_fold")
    scores = [[] for _ in points]

    def vectors(prepared: ColumnTransformModel, part: DataFrame, name: str) -> DataFrame:
        # a row without a price can neither teach nor judge
        return stored(prepared.transform(part).where(F.col(label).isNotNull()).select("features", label), name)

    for k in range(folds):
        learn, judge = folded.where(F.col("_fold") != k), folded.where(F.col("_fold") == k)
        prepared = ColumnTransform(numeric, categorical).fit(learn)
        learn, judge = (vectors(prepared, part, f"fold-{k}") for part in (learn, judge))

        def staged(members: list[int]) -> list[float]:
            longest = max(members, key=trees.__getitem__)
            errors = boost(gbt, learn, points[longest]).evaluateEachIteration(judge, "absolute")
            return [errors[trees[i] - 1] for i in members]

        with ThreadPool(parallelism) as pool:
            for members, found in zip(runs.values(), pool.map(staged, runs.values())):
                for i, score in zip(members, found):
                    scores[i].append(score)
    means = [sum(s) / folds for s in scores]
    best = min(range(len(points)), key=means.__getitem__)
    prepared = ColumnTransform(numeric, categorical).fit(train)
    refitted = PipelineModel(stages=[prepared, gbt.fit(vectors(prepared, train, "train-vectors"), points[best])])
    search = CrossValidatorModel(refitted, means)
    return search._set(estimatorParamMaps=points)


def best_params(search: CrossValidatorModel) -> tuple[dict, float]:
    """Chosen grid point under the grid's names, and its cross-validated MAE."""
    scores = search.avgMetrics
    i = min(range(len(scores)), key=scores.__getitem__)
    names = {v: k for k, v in GBT_PARAMS.items()}
    chosen = {names[p.name]: v for p, v in search.getEstimatorParamMaps()[i].items()}
    return {f"model__{k}": chosen[k] for k in sorted(chosen)}, scores[i]


def predict(model: PipelineModel, holdout: DataFrame, label: str = "price_num",
            columns: Sequence[str] = tuple(PREDICTION_COLUMNS)) -> DataFrame:
    """Output columns that exist, the actual price, and the prediction to 2 digits.

    ``prediction`` keeps the unrounded value the metrics are computed from.
    """
    scored = model.transform(holdout).withColumns({
        "actual_price": F.col(label), "pred_price": round2("prediction")})
    return project_existing(scored, [*columns, "actual_price", "pred_price", "prediction"])


def save_stages(model: PipelineModel, path: str, about: dict | None = None) -> None:
    """Write a fitted pipeline, its preparation included, to a new folder."""
    for i, stage in enumerate(model.stages):
        stage.save(f"{path}/stage-{i}") if isinstance(stage, ColumnTransformModel) else stage.write().save(f"{path}/stage-{i}")
    prepared = [i for i, stage in enumerate(model.stages) if isinstance(stage, ColumnTransformModel)]
    document = json.dumps({"stages": len(model.stages), "prepared": prepared, "about": about or {}})
    SparkSession.active().range(1).select(F.lit(document)).write.text(f"{path}/about")


def load_stages(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """What `save_stages` wrote."""
    document = json.loads(spark.read.text(f"{path}/about").first()[0])
    stages = [ColumnTransformModel.load(spark, f"{path}/stage-{i}") if i in document["prepared"]
              else DefaultParamsReader.loadParamsInstance(f"{path}/stage-{i}", spark.sparkContext) for i in range(document["stages"])]
    return PipelineModel(stages=stages), document["about"]


# ---- tier classifiers -------------------------------------------------------

class TierClassifier:
    """A fitted classifier from raw columns to ``predicted_tier``."""

    def __init__(self, stages: PipelineModel, labels: Sequence[str], text: str | None):
        self.stages, self.labels, self.text = stages, labels, text

    def save(self, path: str) -> None:
        """Write the classifier to a new folder."""
        save_stages(self.stages, path, {"labels": list(self.labels), "text": self.text})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TierClassifier":
        stages, about = load_stages(spark, path)
        return cls(stages, about["labels"], about["text"])

    def transform(self, df: DataFrame, out: str = "predicted_tier") -> DataFrame:
        extra = ["_tokens", "_tf", "_text", "_structured", "_input", "rawPrediction", "probability", "_label"]
        ready = df.withColumn("_tokens", split_tokens(self.text)) if self.text else df
        scored = self.stages.transform(ready)
        return label_decode(scored, self.labels, "prediction", out).drop("prediction", *extra)


def _fit(train: DataFrame, target: str, stages: list, text: str | None) -> TierClassifier:
    encoder = label_encoder(train, target, "_label")
    ready = encoder.transform(train)
    if text:
        ready = ready.withColumn("_tokens", split_tokens(text))
    prepared = Pipeline(stages=stages[:-1]).fit(ready)
    # The head passes over the rows many times: over stored vectors, not over texts or tokens.
    vectors = stored(prepared.transform(ready).select(stages[-1].getFeaturesCol(), "_label"), "vectors")
    return TierClassifier(PipelineModel(stages=[*prepared.stages, stages[-1].fit(vectors)]), encoder.labels, text)


def _text_stages() -> list:
    return [CountVectorizer(inputCol="_tokens", outputCol="_tf", vocabSize=MAX_TOKENS),
            IDF(inputCol="_tf", outputCol="_text")]


def _head(column: str, max_iter: int) -> LogisticRegression:
    return LogisticRegression(featuresCol=column, labelCol="_label", maxIter=max_iter, regParam=0.01,
                              family="multinomial")


def structured_classifier(
    train: DataFrame, target: str = "price_tier", numeric: Sequence[str] = tuple(TIER_NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES), hidden: Sequence[int] | None = None,
    max_iter: int = 50, seed: int = 42,
) -> TierClassifier:
    """Tier from structured fields; ``hidden`` (such as ``[64, 32]``) asks for a dense network."""
    transform = ColumnTransform(numeric, categorical, scale=True, out="_structured")
    if not hidden:
        return _fit(train, target, [transform, _head("_structured", max_iter)], None)
    fitted = transform.fit(train)
    classes = len(label_encoder(train, target).labels)
    net = MultilayerPerceptronClassifier(
        featuresCol="_structured", labelCol="_label", layers=[fitted.width, *hidden, classes],
        maxIter=max_iter, seed=seed)
    return _fit(train, target, [fitted, net], None)


def text_classifier(train: DataFrame, target: str = "price_tier", text: str = "combined_text",
                    max_iter: int = 50) -> TierClassifier:
    """Tier from the listing text alone."""
    return _fit(train, target, [*_text_stages(), _head("_text", max_iter)], text)


def fused_classifier(
    train: DataFrame, target: str = "price_tier", text: str = "combined_text",
    numeric: Sequence[str] = tuple(TIER_NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES), max_iter: int = 50,
) -> TierClassifier:
    """Tier from the structured and the text branch side by side."""
    return _fit(train, target, [
        ColumnTransform(numeric, categorical, scale=True, out="_structured"),
        *_text_stages(),
        VectorAssembler(inputCols=["_structured", "_text"], outputCol="_input"),
        _head("_input", max_iter),
    ], text)
