"""Preparation, parameter search, training and evaluation of the tier classifiers as Spark ML pipelines."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, LogisticRegressionModel, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.functions.numeric import tier_code
from lotmill.operators import metrics
from lotmill.operators.boosting import BoostedTrees
from lotmill.operators.class_trees import ClassTrees, ClassTreesModel
from lotmill.operators.encode import CATEGORIES, feature_columns, feature_stages
from lotmill.operators.linear import SquaredHingeSVM, SquaredHingeSVMModel, logistic_models
from lotmill.operators.sampling import stratified_folds, stratified_split, undersample
from lotmill.operators.selection import FeatureSelector
from lotmill.operators.smote import smote
from lotmill.session import dropped, kept, written


@dataclass
class Prepared:
    """Flat features with ``label`` and ``split``, and the fitted stages that made them."""

    data: DataFrame
    features: list[str]
    stages: PipelineModel

    def part(self, name: str) -> DataFrame:
        return self.data.where(F.col("split") == name)


def prepare(df: DataFrame, current_year: int, target: str = "price_tier", drop: Sequence[str] = ("price",), seed: int = 42,
            test_size: float = 0.2, val_size: float = 0.25, fit_on: str = "train") -> Prepared:
    """Label codes, exact stratified split, then encoders fitted on the training part only.

    ``fit_on='all'`` fits the encoders on every row instead, which lets test data leak into them.
    """
    labelled = df.withColumn("label", tier_code(target)).dropna(subset=["label"]).drop(*[c for c in (target, *drop) if c in df.columns])
    labelled = kept(labelled, "labelled")
    split = kept(stratified_split(labelled, "label", test_size, val_size, seed), "split")
    if "stored_at" in vars(split):  # nothing reads it any more
        dropped(labelled)
    source = split if fit_on == "all" else split.where(F.col("split") == fit_on)
    stages = Pipeline(stages=feature_stages(current_year, [c for c in CATEGORIES if c in df.columns])).fit(source)
    data = written(stages.transform(split).withColumn("label", F.col("label").cast("double")), "features")
    return Prepared(data, feature_columns(data), stages)


def resampled(train: DataFrame, features: Sequence[str], seed: int = 42, kinds: Sequence[str] = ("none", "smote", "undersample")) -> dict[str, DataFrame]:
    """The training part as it is, with synthetic minority rows, and cut to the smallest class."""
    slim = train.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], "label")
    makers = {
        "none": lambda: slim, "smote": lambda: kept(smote(slim, features, "label", seed=seed), "smote"),
        "undersample": lambda: kept(undersample(slim, "label", seed), "undersampled"),
    }
    return {k: makers[k]() for k in kinds}


@dataclass
class Config:
    """An estimator factory, its parameter grid, and how many points of the grid to try.

    With ``fill`` missing features become 0; without it the estimator sees them as NaN.
    """

    make: object
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    tries: int = 10
    scale: bool = False
    fill: bool = True


DEEPEST = 30  # levels of a tree without a depth limit


def _forest(p, rows):
    return RandomForestClassifier(featuresCol="features", labelCol="label", seed=42, numTrees=p["trees"],
                                  maxDepth=min(p["depth"] or DEEPEST, DEEPEST), minInstancesPerNode=max(1, p["min_split"] // 2))


def _extra_trees(p, rows):
    return ClassTrees(trees=p["trees"], depth=p["depth"] or DEEPEST, minSplit=p["min_split"], maxFeatures="sqrt", randomCuts=True)


def _tree(p, rows):
    return ClassTrees(depth=p["depth"] or DEEPEST, minSplit=p["min_split"], minLeaf=p["min_leaf"], criterion=p["criterion"], maxFeatures=p["max_features"] or "all")


def _logistic(p, rows):
    return LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=100, regParam=1.0 / (p["C"] * max(rows, 1)))


def _svm(p, rows):
    if p["loss"] == "squared_hinge":
        return SquaredHingeSVM(C=p["C"])
    return OneVsRest(featuresCol="features", labelCol="label", classifier=LinearSVC(maxIter=100, regParam=1.0 / (p["C"] * max(rows, 1))))


def _boosted(p, rows):
    return BoostedTrees(rounds=p["rounds"], depth=p["depth"], rate=p["rate"], subsample=p["subsample"])


def model_configs() -> dict[str, Config]:
    """The seven classifiers with their grids; ``None`` as depth means DEEPEST levels."""
    grids = rules.PARAMETER_GRIDS
    return {
        "baseline": Config(None, grids["baseline"], 1),
        "random_forest": Config(_forest, grids["random_forest"]),
        "extra_trees": Config(_extra_trees, grids["extra_trees"]),
        "log_reg": Config(_logistic, grids["log_reg"], 5, scale=True),
        "decision_tree": Config(_tree, grids["decision_tree"]),
        "linear_svm": Config(_svm, grids["linear_svm"], scale=True),
        "boosted_trees": Config(_boosted, grids["boosted_trees"], fill=False),
    }


def draw_parameters(grid: Mapping[str, Sequence], tries: int, seed: int = 42) -> list[dict]:
    """Distinct random points of the grid (the whole grid when it is smaller)."""
    names = sorted(grid)
    points = [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]
    return random.Random(seed).sample(points, min(tries, len(points)))


def majority_class(df: DataFrame, label: str = "label") -> float:
    row = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).first()
    return row[label]


def _filled(features: Sequence[str], fill: bool) -> list[str]:
    """SQL of each feature as a known number (or NaN)."""
    number = "nanvl(coalesce(cast(`{}` AS double), 0D), 0D)" if fill else "coalesce(cast(`{}` AS double), double('NaN'))"
    return [number.format(c) for c in features]


def assembled(features: Sequence[str], estimator, scale: bool = False, fill: bool = True) -> Pipeline:
    """Fill with 0 (or NaN), assemble, scale and fit; the fill is a stage, so a saved model scores nulls as it was tested."""
    raw = "raw_features" if scale else "features"
    filled = ", ".join(f"{v} AS `_filled_{i}`" for i, v in enumerate(_filled(features, fill)))
    stages = [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
              VectorAssembler(inputCols=[f"_filled_{i}" for i in range(len(features))], outputCol=raw, handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol=raw, outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, estimator])


def scores(predicted: DataFrame) -> dict:
    pairs = predicted.select(F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))
    return metrics.evaluate(pairs).first().asDict()


def _arrays(part: DataFrame, features: Sequence[str], config: Config, first: PipelineModel) -> DataFrame:
    """What the stages of :func:`assembled` make of ``part``, as ``features array<double>`` straight from the flat columns."""
    values = [F.expr(v) for v in _filled(features, config.fill)]
    if config.scale:
        mean, std = first.stages[-1].mean.toArray().tolist(), first.stages[-1].std.toArray().tolist()
        values = [(v - F.lit(m)) * F.lit(1.0 / s if s else 0.0) for v, m, s in zip(values, mean, std)]
    return part.select(F.array(*values).alias("features"), "label")


def _fitted(estimators: Sequence, ready: DataFrame, arrays: DataFrame, scaled: bool, pool: ThreadPoolExecutor) -> list:
    """Models of all points. Points that learn from the same rows share one written table, and penalties the passes over it."""
    together = [e for e in estimators if isinstance(e, LogisticRegression) and scaled]
    models = dict(zip(map(id, together), logistic_models(arrays, together) if together else []))
    sharing = [e for e in estimators if hasattr(e, "fit_rows")]
    if sharing:
        rows = sharing[0].learning_rows(arrays)  # the points of a search are of one kind
        models |= zip(map(id, sharing), pool.map(lambda e: e.fit_rows(rows), sharing))
        rows.drop()
    rest = [e for e in estimators if id(e) not in models]
    models |= zip(map(id, rest), pool.map(lambda e: e.fit(ready), rest))
    return [models[id(e)] for e in estimators]


def train_one(name: str, dataset: str, train: DataFrame, val: DataFrame, test: DataFrame, features: Sequence[str],
              config: Config | None = None, parallelism: int = 2, seed: int = 42) -> tuple[dict, PipelineModel | None]:
    """Search by validation macro F1; the model that wins is the model that is tested.

    The parts are read again for every point and by the steps of an estimator: hand in written tables, as :func:`prepare` and
    :func:`resampled` make them. They are not cached, as flat features fill memory and spill where a scan is cheap.
    """
    config = config or model_configs()[name]
    if config.make is None:
        label = float(majority_class(train))
        fixed = lambda part: scores(part.select("label", F.lit(label).alias("prediction")))
        return _result(name, dataset, {}, fixed(val)["macro_f1"], fixed(test)), None
    numbers = lambda part: part.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], "label")
    train, val, test = (numbers(part) for part in (train, val, test))
    rows = train.count()

    first = Pipeline(stages=assembled(features, None, config.scale, config.fill).getStages()[:-1]).fit(train)  # the same for every point
    points = draw_parameters(config.grid, config.tries, seed)
    estimators = [config.make(p, rows) for p in points]
    with ThreadPoolExecutor(parallelism) as pool:
        models = _fitted(estimators, first.transform(train), _arrays(train, features, config, first), config.scale, pool)

        def attempt(model):
            tried = first.transform(val)
            if isinstance(model, (ClassTreesModel, SquaredHingeSVMModel, LogisticRegressionModel)):
                tried = _arrays(val, features, config, first)
                if isinstance(model, LogisticRegressionModel):
                    tried = tried.withColumn("features", array_to_vector("features"))
            return scores(model.transform(tried))["macro_f1"], PipelineModel(stages=[*first.stages, model])

        attempts = list(pool.map(attempt, models))
    best = max(range(len(points)), key=lambda i: (attempts[i][0], -i))
    val_f1, model = attempts[best]
    result = _result(name, dataset, points[best], val_f1, scores(model.transform(test)))
    result["attempts"] = [(p, f1) for p, (f1, _) in zip(points, attempts)]
    return result, model


def _result(name, dataset, params, val_f1, tested) -> dict:
    return {
        "model": name, "dataset": dataset, "val_f1": val_f1, "test_f1": tested["macro_f1"], "test_bal_acc": tested["balanced_accuracy"],
        "luxury_recall": tested["luxury_recall"], "severe_misclassification_rate": tested["severe_misclassification_rate"], "best_params": params,
    }


RESULT_SCHEMA = ("model string, dataset string, val_f1 double, test_f1 double, test_bal_acc double, luxury_recall double, "
                 "severe_misclassification_rate double, best_params map<string,string>")


def train_all(df: DataFrame, current_year: int, models: Sequence[str] | None = None, datasets: Sequence[str] = ("none", "smote", "undersample"),
              configs: Mapping[str, Config] | None = None, selector: FeatureSelector | None = None, log_path: str | None = None,
              parallelism: int = 2, attempts: list | None = None) -> DataFrame:
    """Every model on every dataset variant; one result row each, best test F1 first.

    ``attempts`` collects every point tried: model, dataset, parameters, validation score. With ``log_path`` each run appends its parameters and metrics to ``<log_path>/runs`` and saves
    its model (with the feature stages) under ``<log_path>/models/<model>_<dataset>``.
    """
    from lotmill.sources.tables import append_run

    configs = configs or model_configs()
    prepared = prepare(df, current_year)
    features = prepared.features
    if selector is not None:
        features = selector.fit(prepared.part("train"), features).selected
    variants = resampled(prepared.part("train"), features, kinds=datasets)
    results = []
    for name in models or list(configs):
        for dataset, rows in variants.items():
            result, model = train_one(name, dataset, rows, prepared.part("val"), prepared.part("test"), features, configs[name], parallelism)
            results.append(result)
            if attempts is not None:
                attempts += [(name, dataset, {k: str(v) for k, v in p.items()}, f1) for p, f1 in result.get("attempts", [])]
            if log_path:
                append_run(df.sparkSession, f"{log_path}/runs", result)
                if model is not None:
                    whole = PipelineModel(stages=[*prepared.stages.stages, *model.stages])
                    whole.write().overwrite().save(f"{log_path}/models/{name}_{dataset}")
    rows = [{**r, "best_params": {k: str(v) for k, v in r["best_params"].items()}} for r in results]
    names = [c.split()[0] for c in RESULT_SCHEMA.split(", ")]
    table = df.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in rows], RESULT_SCHEMA)
    return table.orderBy(F.desc("test_f1"), "model", "dataset")


def cross_validate(df: DataFrame, features: Sequence[str], config: Config, params: Mapping, label: str = "label", folds: int = 5, seed: int = 42,
                   unique_key: Sequence[str] | None = None) -> DataFrame:
    """``df`` with ``fold`` and ``prediction``: every row is scored once, by the model that was fitted without its fold.

    Score the pooled rows once with :func:`scores`. Folds are stratified; rows without a label are left out.
    """
    dealt = written(stratified_folds(df, label, folds, seed, unique_key), "folds")
    sizes = {r["fold"]: r["count"] for r in dealt.groupBy("fold").count().collect()}
    out = None
    for fold in sorted(sizes):
        numbers = dealt.where(F.col("fold") != fold).select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], F.col(label).cast("double").alias("label"))
        model = assembled(features, config.make(params, sum(sizes.values()) - sizes[fold]), config.scale, config.fill).fit(numbers)
        scored = model.transform(dealt.where(F.col("fold") == fold)).select(*[F.col(f"`{c}`") for c in dealt.columns], "prediction")
        out = scored if out is None else out.unionByName(scored)
    if out is None:
        return dealt.withColumn("prediction", F.lit(None).cast("double"))
    return out


TIER_NAMES = {code: tier for tier, code in rules.TIER_CODES.items()}
