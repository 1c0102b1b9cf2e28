"""Fitted models of customer value and churn on ``pyspark.ml``, from features to scores.

Every model is a ``PipelineModel`` that takes the feature table itself, so what is saved
and loaded again scores customers without anything beside it. Scores go out as plain
columns; metrics come from ``scoring``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.operators import scoring
from patronage.operators.churn import FEATURES
from patronage.operators.oversampling import oversample
from patronage.operators.splitting import exact_split
from patronage.params import Params
from patronage.session import scratch_root, stage

# Names of the value features.
VALUE_FEATURES = (
    "recency",
    "frequency",
    "monetary",
    "avg_order_value",
    "unique_products",
    "total_quantity",
    "tenure_days",
    "avg_days_between",
    "items_per_order",
)
LOGISTIC, BOOSTED = "Logistic Regression", "Boosted Trees"
LINEAR, FOREST = "Linear Regression", "Random Forest"


@dataclass(frozen=True)
class Fitted:
    """A model, its scores on the test rows (id, label, score), and what each feature
    counts for (feature, importance)."""

    name: str
    model: PipelineModel
    test: DataFrame
    importance: DataFrame


def numbers(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as doubles; null and not-a-number become 0."""
    filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features}
    return df.withColumns(filled)


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def _importance(spark, features: Sequence[str], values) -> DataFrame:
    return spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    )


# ---- churn


def balanced_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """A column ``weight``: rows over twice the rows of the class."""
    counts = rows.groupBy(label).count()
    everything = Window.partitionBy()  # of one row per class
    weights = counts.select(label, (F.sum("count").over(everything) / (2 * F.col("count"))).alias("weight"))
    return rows.join(F.broadcast(weights), label)


def fit_logistic(train: DataFrame, features: Sequence[str], params: Params, weight: str | None = None) -> PipelineModel:
    """Ridge logistic regression on features of mean 0 and population deviation 1; the
    penalty is half the squared weights against the summed loss. A constant feature has
    no weight."""
    total = train.agg(F.count("*").alias("n"), (F.sum(weight) if weight else F.count("*")).alias("w")).first()
    n, w = total["n"], float(total["w"])
    # The scaler divides by the sample deviation.
    to_population = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
    steps = [
        _assembler(features),
        StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="centred", outputCol="scaled", scalingVec=Vectors.dense([to_population] * len(features))
        ),
        LogisticRegression(
            featuresCol="scaled", labelCol="label", maxIter=params.logistic_iterations, tol=1e-10,
            regParam=1 / w, elasticNetParam=0.0, standardization=False, **({"weightCol": weight} if weight else {}),
        ),
    ]
    return Pipeline(stages=steps).fit(train)


def fit_boosted(train: DataFrame, features: Sequence[str], params: Params, weight: str | None = None) -> PipelineModel:
    """Boosted trees; node ids are checkpointed every ten rounds, so the plan stays short."""
    scratch_root(train.sparkSession)  # names the checkpoint folder
    trees = GBTClassifier(
        labelCol="label", maxIter=params.boosting_rounds, maxDepth=params.churn_boost_depth,
        stepSize=params.learning_rate, subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.subsample), seed=params.seed, cacheNodeIds=True, checkpointInterval=10,
        **({"weightCol": weight} if weight else {}),
    )
    return Pipeline(stages=[_assembler(features), trees]).fit(train)


def churn_scores(model: PipelineModel, rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """``rows`` with ``score``, the probability of class 1."""
    scored = model.transform(numbers(rows, features))
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("score"))


@dataclass(frozen=True)
class ChurnModels:
    fitted: list[Fitted]
    balance: str

    def best(self) -> Fitted:
        """Boosted trees where they were fitted."""
        return next((f for f in self.fitted if f.name == BOOSTED), self.fitted[0])


def train_churn(
    features: DataFrame, labels: DataFrame, params: Params = Params(), smote: bool = True, boosted: bool = True
) -> ChurnModels:
    """Logistic regression and boosted trees on four fifths of the labelled customers.

    The split is exact within each label. The smaller class of the training rows is
    oversampled before scaling (``smote``); otherwise the logistic regression weighs the
    classes equally and the trees weigh class 1 by class 0 over class 1. Customers
    without a label are not used. Both classes must be among the training rows.
    """
    spark = features.sparkSession
    data = numbers(features.join(labels.select("CustomerID", F.col("churned").alias("label")), "CustomerID"), FEATURES)
    data = data.where("label in (0, 1)").select("CustomerID", *FEATURES, F.col("label").cast("int").alias("label"))
    parts = stage(exact_split(stage(data, "labelled"), "CustomerID", params.test_share, "label"), "parts")
    train, test = parts.where(~F.col("is_test")), parts.where("is_test")
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) == 0:
        raise ValueError("training rows need both classes")
    if smote:
        vector = F.array(*FEATURES)
        more = oversample(train.select(F.col("CustomerID").alias("id"), vector.alias("v"), "label"),
                          params.seed, params.neighbours, features="v")
        train = more.select("label", *[F.col("features")[i].alias(c) for i, c in enumerate(FEATURES)])
        weights = (None, None)
    else:
        train = balanced_weights(train).withColumn(
            "positive_weight", F.when(F.col("label") == 1, counts[0] / counts[1]).otherwise(1.0)
        )
        weights = ("weight", "positive_weight")
    train = stage(train.withColumn("label", F.col("label").cast("double")), "training")
    fitted = []
    plans = [(LOGISTIC, fit_logistic, weights[0])] + ([(BOOSTED, fit_boosted, weights[1])] if boosted else [])
    for name, fit, weight in plans:
        model = fit(train, FEATURES, params, weight)
        last = model.stages[-1]
        values = [abs(v) for v in last.coefficients] if name == LOGISTIC else last.featureImportances.toArray()
        scored = stage(churn_scores(model, test).select("CustomerID", "label", "score"), "test_scores")
        fitted.append(Fitted(name, model, scored, _importance(spark, FEATURES, values)))
    return ChurnModels(fitted, "oversampling" if smote else "class weights")


def churn_comparison(models: ChurnModels, threshold: float = 0.5) -> DataFrame:
    """model, auc_roc, and weighted precision, recall and F1 on the test rows."""
    table = None
    for f in models.fitted:
        report = scoring.classification_report(f.test, threshold).where(F.col("class") == "weighted avg")
        row = report.crossJoin(scoring.auc(f.test)).select(  # one row each
            F.lit(f.name).alias("model"), "auc_roc", "precision", "recall", F.col("f1_score").alias("f1")
        )
        table = row if table is None else table.unionByName(row)
    return table


# ---- value


@dataclass(frozen=True)
class ValueModels:
    fitted: list[Fitted]
    comparison: DataFrame

    def best(self) -> Fitted:
        """The model of least mean absolute error; of equal ones the first."""
        errors = {r["model"]: r["mae"] for r in self.comparison.collect()}
        return min(self.fitted, key=lambda f: errors[f.name])


def value_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``score``, the predicted spend, 0 at least."""
    scored = model.transform(numbers(rows, VALUE_FEATURES))
    return scored.select(*rows.columns, F.greatest(F.lit(0.0), F.col("prediction")).alias("score"))


def train_value(features: DataFrame, params: Params = Params(), boosted: bool = True) -> ValueModels:
    """Linear regression, random forest and boosted trees for the spend of the holdout
    period, on four fifths of the customers, compared on the rest."""
    spark = features.sparkSession
    scratch_root(spark)
    data = numbers(features, [*VALUE_FEATURES, "holdout_revenue"]).select(
        "CustomerID", *VALUE_FEATURES, F.col("holdout_revenue").alias("label")
    )
    parts = stage(exact_split(stage(data, "value_rows"), "CustomerID", params.test_share), "value_parts")
    train, test = parts.where(~F.col("is_test")), parts.where("is_test")
    common = {"labelCol": "label", "seed": params.seed, "cacheNodeIds": True, "checkpointInterval": 10}
    # The normal equations: one aggregate of products of the features.
    plans = [(LINEAR, LinearRegression(labelCol="label", solver="normal", regParam=0.0))]
    plans.append((FOREST, RandomForestRegressor(
        numTrees=params.regression_trees, maxDepth=params.regression_tree_depth,
        featureSubsetStrategy="all", subsamplingRate=1.0, **common)))
    if boosted:
        plans.append((BOOSTED, GBTRegressor(
            maxIter=params.boosting_rounds, maxDepth=params.regression_boost_depth, stepSize=params.learning_rate,
            subsamplingRate=params.subsample, featureSubsetStrategy=str(params.subsample), **common)))
    fitted, table = [], None
    for name, estimator in plans:
        model = Pipeline(stages=[_assembler(VALUE_FEATURES), estimator]).fit(train)
        last = model.stages[-1]
        values = [abs(v) for v in last.coefficients] if name == LINEAR else last.featureImportances.toArray()
        scored = stage(value_scores(model, test).select("CustomerID", "label", "score"), "value_scores")
        fitted.append(Fitted(name, model, scored, _importance(spark, VALUE_FEATURES, values)))
        row = scoring.regression_metrics(scored).select(F.lit(name).alias("model"), "*")
        table = row if table is None else table.unionByName(row)
    return ValueModels(fitted, stage(table, "value_comparison"))
