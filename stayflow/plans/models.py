"""Training and scoring with Spark ML on one sparse vector layout.

Text columns go through index + one-hot into sparse vectors, so the number of levels
never becomes a number of columns. Levels unseen in training fall into one extra slot.
"""
from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window, functions as F

from stayflow.functions.keys import split_key
from stayflow.operators.evaluate import confidence, flip_probability, roc_auc
from stayflow.operators.sampling import downsample, stratified_folds
from stayflow.session import materialize

# The searched grid, 4*4*3*4*4 settings, in the terms Spark's trees have.
FULL_GRID = {
    "maxDepth": [3, 4, 5, 6],
    "maxIter": [50, 100, 150, 200],
    "stepSize": [0.05, 0.1, 0.2],
    "subsamplingRate": [0.6, 0.7, 0.8, 1.0],
    "minInstancesPerNode": [1, 5, 10, 20],
}


def feature_stages(texts: Sequence[str], numbers: Sequence[str]) -> list:
    """Impute numbers by their median, index and one-hot the texts, assemble."""
    stages: list = []
    inputs: list[str] = []
    if numbers:
        filled = [f"{c}__f" for c in numbers]
        stages.append(Imputer(inputCols=list(numbers), outputCols=filled, strategy="median"))
        inputs += filled
    if texts:
        index, hot = [f"{c}__i" for c in texts], [f"{c}__h" for c in texts]
        stages.append(StringIndexer(inputCols=list(texts), outputCols=index, handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, handleInvalid="keep"))
        inputs += hot
    return stages + [VectorAssembler(inputCols=inputs, outputCol="features")]


def model_input(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Numbers as double, missing text as its own level; only the columns needed."""
    return df.select(
        *keep,
        *[F.col(c).cast("double").alias(c) for c in numbers],
        *[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in texts],
    )


def with_class_weight(df: DataFrame, label: str = "status") -> DataFrame:
    """Weight n0/n1 for positives, 1 for the rest."""
    r = df.agg(F.count(F.when(F.col(label) == 0, 1)).alias("n0"), F.count(F.when(F.col(label) == 1, 1)).alias("n1")).first()
    weight = r["n0"] / r["n1"] if r["n1"] else 1.0
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(1.0))


def gbt(label: str = "status", weight: str | None = "weight", seed: int = 0, **params) -> GBTClassifier:
    made = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **({"maxDepth": 4, "maxIter": 20} | params))
    return made.setWeightCol(weight) if weight else made


def train_gbt(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], label: str = "status", key: str = "chc_id", seed: int = 0, **params) -> PipelineModel:
    rows = with_class_weight(model_input(df, texts, numbers, [key, label]), label)
    return Pipeline(stages=[*feature_stages(texts, numbers), gbt(label, seed=seed, **params)]).fit(rows)


def score(model: PipelineModel, df: DataFrame, texts: Sequence[str], numbers: Sequence[str], keep: Sequence[str] = ("chc_id",)) -> DataFrame:
    """Predicted label, probability of leaving and confidence in the label."""
    p1 = vector_to_array("probability").getItem(1)
    out = model.transform(model_input(df, texts, numbers, list(keep)))
    return out.select(*keep, p1.alias("p1")).select(
        *keep,
        F.when(F.col("p1") >= 0.5, 1).otherwise(0).alias("predicted_label"),
        confidence(F.col("p1")).alias("prediction_probability"),
        "p1",
    )


def batch_score(model: PipelineModel, df: DataFrame, texts: Sequence[str], numbers: Sequence[str], run_month: int, run_id: str, key: str = "chc_id", composite: str | None = None) -> DataFrame:
    """Scores of a month with the key split into its parts and a run id."""
    keep = [key] + ([composite] if composite else [])
    parts = split_key(F.col(composite or key).cast("string"))
    return score(model, df, texts, numbers, keep).select(
        F.lit(run_id).alias("run_id"), F.lit(run_month).alias("run_month"), *keep,
        *[c.alias(n) for n, c in parts.items()], "predicted_label", "prediction_probability",
    )


def feature_names(model: PipelineModel, df: DataFrame, texts: Sequence[str], numbers: Sequence[str]) -> list[tuple[str, str]]:
    """(attribute, level-or-attribute) of every slot of the feature vector, in order."""
    names = [(c, c) for c in numbers]
    if texts:
        labels = next(s for s in model.stages if hasattr(s, "labelsArray")).labelsArray
        sizes = {s: len(v) for s, v in zip(texts, labels)}
        hot = next(s for s in model.stages if hasattr(s, "categorySizes")).categorySizes
        for c, vs, width in zip(texts, labels, hot):
            slots = [f"{c}_{v}" for v in vs] + [f"{c}_(unseen)"] * max(0, width - sizes[c])
            names += [(c, s) for s in slots]
    return names


def feature_importance(model: PipelineModel, df: DataFrame, texts: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """(feature, attribute, gain, ranking) from the fitted ensemble, best first."""
    gains = model.stages[-1].featureImportances
    names = feature_names(model, df, texts, numbers)
    rows = [(n, a, float(gains[i])) for i, (a, n) in enumerate(names) if i < gains.size]
    out = df.sparkSession.createDataFrame(rows, "feature string, attribute string, gain double")
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("gain"), F.asc("feature"))  # one row per slot
    return out.withColumn("ranking", F.row_number().over(w))


def kfold_importance(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], k: int = 5, label: str = "status", key: str = "chc_id", seed: int = 0, **params) -> DataFrame:
    """Mean gain of every feature over ``k`` stratified folds, with its attribute."""
    folds = materialize(stratified_folds(df.select(key, label, *texts, *numbers), k, key, label, seed), "folds")
    out = None
    for i in range(k):
        fit = train_gbt(folds.filter(F.col("fold") != i), texts, numbers, label, key, seed, **params)
        one = feature_importance(fit, df, texts, numbers).select("feature", "attribute", "gain")
        out = one if out is None else out.unionByName(one)
    mean = out.groupBy("feature", "attribute").agg((F.sum("gain") / k).alias("ranking_metric_gain"))
    return mean.orderBy(F.desc("ranking_metric_gain"), F.asc("feature"))


def param_grid(model, grid: Mapping[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    return builder.build()


def random_draws(model, space: Mapping[str, Sequence], draws: int, seed: int) -> list[dict]:
    """Seeded settings drawn from the listed values, repeats left out."""
    rng = random.Random(seed)
    space = {n: list(dict.fromkeys(v)) for n, v in space.items()}  # a value listed twice is one value
    found: dict[tuple, dict] = {}
    total = 1
    for v in space.values():
        total *= len(v)
    while len(found) < min(draws, total):
        pick = tuple((n, rng.choice(v)) for n, v in space.items())
        found[pick] = {model.getParam(n): v for n, v in pick}
    return list(found.values())


def search(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], settings, k: int = 3, label: str = "status", key: str = "chc_id", seed: int = 0, parallelism: int = 4, weighted: bool = True):
    """Cross-validated AUC of each setting; returns (best model, trial table).

    Rows are folded once by key hash and written out, vectors are built once, and the
    settings run side by side on the cluster.
    """
    rows = stratified_folds(model_input(df, texts, numbers, [key, label]), k, key, label, seed)
    rows = with_class_weight(rows, label) if weighted else rows.withColumn("weight", F.lit(1.0))
    prepared = Pipeline(stages=feature_stages(texts, numbers)).fit(rows)
    vectors = materialize(prepared.transform(rows).select(F.col(label).cast("double").alias(label), "weight", "fold", "features"), "vectors")
    learner = gbt(label, seed=seed)
    grid = settings(learner)
    cv = CrossValidator(
        estimator=learner, estimatorParamMaps=grid, numFolds=k, foldCol="fold", parallelism=parallelism, seed=seed,
        evaluator=BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction"),
    ).fit(vectors)
    trials = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda x: x[0].name)), float(a)) for i, (g, a) in enumerate(zip(grid, cv.avgMetrics))]
    table = df.sparkSession.createDataFrame(trials, "trial int, settings string, auc double").orderBy(F.desc("auc"), "trial")
    return PipelineModel([*prepared.stages, cv.bestModel]), table


def grid_search(df, texts, numbers, grid: Mapping[str, Sequence] = FULL_GRID, **kw):
    return search(df, texts, numbers, lambda m: param_grid(m, grid), **kw)


def random_search(df, texts, numbers, space: Mapping[str, Sequence] = FULL_GRID, draws: int = 50, seed: int = 0, **kw):
    return search(df, texts, numbers, lambda m: random_draws(m, space, draws, seed), seed=seed, **kw)


def backward_selection(df: DataFrame, numbers: Sequence[str], smallest: int = 3, largest: int = 25, k: int = 3, label: str = "status", key: str = "chc_id", seed: int = 0, **params) -> DataFrame:
    """Drops the feature whose loss costs the least cross-validated AUC, step by step.

    Returns one row per subset size from ``largest`` down to ``smallest``. The folds
    are written once; each candidate is a distributed fit.
    """
    rows = materialize(with_class_weight(stratified_folds(model_input(df, [], numbers, [key, label]), k, key, label, seed), label), "backward")
    filled = Imputer(inputCols=list(numbers), outputCols=list(numbers), strategy="median").fit(rows).transform(rows)
    judge = BinaryClassificationEvaluator(labelCol=label)

    def auc(cols: Sequence[str]) -> float:
        vectors = VectorAssembler(inputCols=list(cols), outputCol="features").transform(filled)
        total = 0.0
        for i in range(k):
            fit = gbt(label, seed=seed, **params).fit(vectors.filter(F.col("fold") != i))
            total += judge.evaluate(fit.transform(vectors.filter(F.col("fold") == i)))
        return total / k

    current, steps = list(numbers), []
    if len(current) <= largest:
        steps.append((len(current), ",".join(current), auc(current)))
    while len(current) > smallest:
        trials = {c: auc([x for x in current if x != c]) for c in current}
        worst = max(sorted(trials), key=trials.get)
        current.remove(worst)
        if len(current) <= largest:
            steps.append((len(current), ",".join(current), trials[worst]))
    return df.sparkSession.createDataFrame(steps, "n_features int, features string, auc double")


def score_splits(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], split: str = "split", label: str = "status", key: str = "chc_id", seed: int = 0, **params) -> DataFrame:
    """Fit on the down-sampled training rows, score sample, train, test and all.

    One score per customer; the split tags are attached afterwards.
    """
    rows = materialize(df.select(key, label, split, *texts, *numbers), "splits")
    sample = materialize(downsample(rows.filter(F.col(split) == "train"), key, label, seed), "sample")
    model = train_gbt(sample, texts, numbers, label, key, seed, **params)
    scored = score(model, rows, texts, numbers, [key, label, split])
    tagged = scored.join(sample.select(key, F.lit(1).alias("_s")), key, "left")
    tags = F.array_compact(F.array(F.lit("all"), F.col(split), F.when(F.col("_s") == 1, "sample")))
    return tagged.select(F.explode(tags).alias("scored_on"), key, label, "predicted_label", "p1")


def split_metrics(scores: DataFrame, label: str = "status") -> DataFrame:
    """AUC of each scored part."""
    out = None
    for name in ("sample", "train", "test", "all"):
        one = roc_auc(scores.filter(F.col("scored_on") == name), "p1", label).select(F.lit(name).alias("scored_on"), "auc")
        out = one if out is None else out.unionByName(one)
    return out


def segment_tree(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], label: str = "status", key: str = "chc_id", depth: int = 4, seed: int = 0):
    """A shallow tree over coded features; returns (model, leaf table, rules text)."""
    rows = model_input(df, texts, numbers, [key, label])
    index = [f"{c}__i" for c in texts]
    stages: list = [StringIndexer(inputCols=list(texts), outputCols=index, handleInvalid="keep")] if texts else []
    filled = [f"{c}__f" for c in numbers]
    if numbers:
        stages.append(Imputer(inputCols=list(numbers), outputCols=filled, strategy="median"))
    stages.append(VectorAssembler(inputCols=[*index, *filled], outputCol="features"))
    tree = DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=depth, leafCol="leaf", seed=seed, maxBins=256)
    model = Pipeline(stages=[*stages, tree]).fit(rows)
    leaves = model.transform(rows).groupBy(F.col("leaf").cast("int").alias("leaf")).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate"))
    return model, leaves, model.stages[-1].toDebugString


__all__ = [
    "FULL_GRID", "backward_selection", "batch_score", "feature_importance", "flip_probability", "grid_search",
    "kfold_importance", "random_search", "score", "score_splits", "segment_tree", "split_metrics", "train_gbt",
]
