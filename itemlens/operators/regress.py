"""Regression models (M1-M14) on MLlib: assembly, pipelines, model comparison and feature importances.

Fitting is distributed by MLlib (tree statistics and normal-equation sums are aggregated over partitions); the
driver only holds model coefficients. Splits are key-hash splits so a retried task never moves a row between sides.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemlens.operators.evaluate import regression_metrics
from itemlens.operators.split import hash_split
from itemlens.operators.topk import global_rank

# Model settings of the reference (trees 20 x depth 5, boosting 20 x depth 3); seeds are explicit.
RF_TREES = 20
RF_DEPTH = 5
GBT_ITER = 20
GBT_DEPTH = 3
SEED = 42


def make_models(label: str, features: str = "features") -> dict:
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    return {
        "Linear Regression": LinearRegression(featuresCol=features, labelCol=label),
        "Random Forest": RandomForestRegressor(
            featuresCol=features, labelCol=label, numTrees=RF_TREES, maxDepth=RF_DEPTH, seed=SEED
        ),
        "Gradient Boosting": GBTRegressor(
            featuresCol=features, labelCol=label, maxIter=GBT_ITER, maxDepth=GBT_DEPTH, seed=SEED
        ),
    }


def assembler(inputs: list[str], out: str = "features"):
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=inputs, outputCol=out)


def fit_pipeline(train: DataFrame, stages: list):
    """Fit a pipeline. MLlib passes over its input several times (metadata, statistics, summary), so the input is
    persisted (memory and disk) for the fit and released afterwards, unless the caller already cached it."""
    from pyspark import StorageLevel
    from pyspark.ml import Pipeline

    owned = not train.is_cached
    if owned:
        train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(train)
    finally:
        if owned:
            train.unpersist()


def compare_models(
    spark: SparkSession,
    df: DataFrame,
    label: str,
    features: list[str],
    key_cols: list[str],
    train_pct: int = 80,
) -> tuple[DataFrame, dict]:
    """Fit LR, RF and GBT on one hash split; return the comparison table and the fitted pipelines.

    Rows with a null label or feature are dropped first (F1). The table holds figures, not a plan: using it again costs
    nothing.
    """
    data = df.dropna(subset=[label, *features])
    train, test = hash_split(data, key_cols, train_pct)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    fitted = {name: fit_pipeline(train, [assembler(features), model]) for name, model in make_models(label).items()}
    train.unpersist()
    # All models score a test row in the same pass: one aggregation, one row to the driver.
    scored, aggs = test.select(F.col(label).alias("_label"), *features), []
    for i, pipe in enumerate(fitted.values()):
        scored = pipe.transform(scored).withColumnRenamed("prediction", f"_p{i}").drop("features")
        err = F.col("_label") - F.col(f"_p{i}")
        aggs += [
            F.sqrt(F.avg(err * err)).alias(f"rmse{i}"),
            F.avg(F.abs(err)).alias(f"mae{i}"),
            (1 - F.try_divide(F.sum(err * err), F.count(F.lit(1)) * F.var_pop("_label"))).alias(f"r2{i}"),
        ]
    row = scored.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    rows = [(name, label, row[f"rmse{i}"], row[f"mae{i}"], row[f"r2{i}"], row["n"]) for i, name in enumerate(fitted)]
    return spark.createDataFrame(rows, "model string, target string, rmse double, mae double, r2 double, n bigint"), fitted


def _tree(node, features: list[str]) -> Column:
    if "Leaf" in node.getClass().getSimpleName():
        return F.lit(float(node.prediction()))
    split = node.split()
    goes_left = F.col(features[split.featureIndex()]).cast("double") <= F.lit(float(split.threshold()))
    return F.when(goes_left, _tree(node.leftChild(), features)).otherwise(_tree(node.rightChild(), features))


def tree_expression(model, features: list[str]) -> Column:
    """M7/M8: a fitted forest or boosted model as one expression of nested ``when`` over the feature columns, so
    it can be applied where MLlib isn't at hand, and checked. Features are numeric and not null."""
    trees = [_tree(t._call_java("rootNode"), features) for t in model.trees]
    weights = list(model.treeWeights)
    total = F.lit(0.0)
    for tree, weight in zip(trees, weights):
        total = total + tree * F.lit(float(weight))
    return total if "GBT" in type(model).__name__ else total / F.lit(float(sum(weights)))


def category_index(df: DataFrame, category: str) -> DataFrame:
    """M2 as a table: (category, idx, n), the most frequent category first, ties by name; nulls don't count.

    A category outside of the table has the index after the last. One row per category goes through the ranking, which is
    a distributed sort (:func:`itemlens.operators.topk.global_rank`).
    """
    counts = df.filter(F.col(category).isNotNull()).groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return global_rank(counts, [F.desc("n"), "category"], "idx").select("category", (F.col("idx") - 1).alias("idx"), "n")


def feature_importances(spark: SparkSession, pipeline_model, features: list[str]) -> DataFrame:
    """Importances of the last (tree) stage as (feature, importance), largest first."""
    imp = pipeline_model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def encoder_stages(categorical: list[str]) -> list:
    """M2/M3: index each category (``<name>_idx``; unseen and null ones get the index after the last), then one-hot encode
    (``<name>_enc``)."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    indexers = [StringIndexer(inputCol=c, outputCol=c + "_idx", handleInvalid="keep") for c in categorical]
    names = [c + "_idx" for c in categorical], [c + "_enc" for c in categorical]
    return [*indexers, OneHotEncoder(inputCols=names[0], outputCols=names[1])]


def categorical_pipeline(df: DataFrame, label: str, numeric: list[str], categorical: list[str], key_cols: list[str]):
    """M2-M4: index categories (unseen and null categories get an extra index), one-hot encode, assemble with the
    numeric columns and fit a linear regression. Returns (metrics DataFrame, fitted pipeline)."""
    from pyspark.ml.regression import LinearRegression

    data = df.dropna(subset=[label, *numeric])
    train, test = hash_split(data, key_cols)
    asm = assembler(numeric + [c + "_enc" for c in categorical])
    model = LinearRegression(featuresCol="features", labelCol=label)
    pipe = fit_pipeline(train, [*encoder_stages(categorical), asm, model])
    return regression_metrics(pipe.transform(test), label=label), pipe


def train_regression(df: DataFrame, features: list[str], label: str, key_cols: list[str]):
    """Assemble, split, fit a linear regression and score the held-out side. Returns (model, metrics)."""
    from pyspark.ml.regression import LinearRegression

    data = df.dropna(subset=[label, *features])
    train, test = hash_split(data, key_cols)
    pipe = fit_pipeline(train, [assembler(features), LinearRegression(featuresCol="features", labelCol=label)])
    return pipe, regression_metrics(pipe.transform(test), label=label)
