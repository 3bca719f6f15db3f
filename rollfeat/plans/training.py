"""Training set and boosted trees on Spark MLlib. Only the final ranking is small; everything else stays distributed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollfeat.sources.tables import typed

LABEL = "tx_fraud"
HELD_OUT = "__held_out"
NOT_FEATURES = ("tx_id", "tx_ts", "tx_date", "customer_id", "terminal_id", "created_timestamp")
NOT_FEATURES_SERVED = ("tx_id", "timestamp", "entity_type_customer", "entity_type_terminal", "created_timestamp")


def training_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES, label: str = LABEL) -> list[str]:
    return [c for c in df.columns if c not in (*exclude, label)]


def training_frame(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES, label: str = LABEL) -> DataFrame:
    """Everything but ids, times and bookkeeping."""
    return df.drop(*[c for c in exclude if c in df.columns])


@dataclass(frozen=True)
class FeaturePlan:
    """How the columns of a training frame become a feature vector.

    MLlib trees have no branch for missing values. A number that can be missing gets a flag column and a constant in
    its place.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    label: str = LABEL
    missing_value: float = 0.0

    @classmethod
    def of(cls, frame: DataFrame, categorical: Sequence[str] = ("day_of_the_week",), label: str = LABEL) -> FeaturePlan:
        names = [c for c in frame.columns if c != label]
        return cls(tuple(c for c in names if c not in categorical), tuple(c for c in names if c in categorical), label)

    @property
    def inputs(self) -> list[tuple[str, str]]:
        """(vector input, feature it belongs to), in vector order."""
        return (
            [(f"{c}__index", c) for c in self.categorical]
            + [(c, c) for c in self.numeric]
            + [(f"{c}__missing", c) for c in self.numeric]
        )

    def fill(self, frame: DataFrame) -> DataFrame:
        """Labelled rows only, numbers as double with their missing flags."""
        labelled = typed(frame).where(F.col(self.label).isNotNull())
        return labelled.select(
            F.col(self.label).cast("double").alias(self.label),
            *self.categorical,
            *[F.coalesce(F.col(c).cast("double"), F.lit(self.missing_value)).alias(c) for c in self.numeric],
            *[F.col(c).isNull().cast("double").alias(f"{c}__missing") for c in self.numeric],
        )

    def encoder(self) -> list:
        """Categories are numbered by frequency in the frame this is fitted on; unseen ones get a number of their own."""
        indexers = [
            StringIndexer(inputCol=c, outputCol=f"{c}__index", handleInvalid="keep", stringOrderType="frequencyDesc")
            for c in self.categorical
        ]
        return [*indexers, VectorAssembler(inputCols=[i for i, _ in self.inputs], outputCol="features")]


# Category values come to the driver when they are numbered; more of them are refused.
MOST_CATEGORIES = 10_000


def check_categories(train: DataFrame, plan: FeaturePlan) -> None:
    counts = train.agg(*[F.approx_count_distinct(c).alias(c) for c in plan.categorical]).first() if plan.categorical else {}
    many = [c for c in plan.categorical if counts[c] > MOST_CATEGORIES]
    if many:
        raise ValueError(f"too many distinct values for categories: {', '.join(many)}; hash or group them first")


def fit(
    train: DataFrame, plan: FeaturePlan, rounds: int = 100, depth: int = 6, step: float = 0.3, validation: DataFrame | None = None, **options
) -> PipelineModel:
    """Boosted regression trees on the 0/1 label. Encoders see the training rows only.

    With ``validation`` rows, boosting ends once their error stops falling (``validationTol``).
    """
    check_categories(train, plan)
    filled = plan.fill(train)
    if validation is not None:
        encoder = Pipeline(stages=plan.encoder()).fit(filled)
        both = filled.withColumn(HELD_OUT, F.lit(False)).unionByName(plan.fill(validation).withColumn(HELD_OUT, F.lit(True)))
        trees = GBTRegressor(
            featuresCol="features", labelCol=plan.label, predictionCol="prediction", validationIndicatorCol=HELD_OUT,
            maxIter=rounds, maxDepth=depth, stepSize=step, seed=7, **options,
        )
        return PipelineModel(stages=[*encoder.stages, trees.fit(encoder.transform(both))])
    trees = GBTRegressor(
        featuresCol="features", labelCol=plan.label, predictionCol="prediction",
        maxIter=rounds, maxDepth=depth, stepSize=step, seed=7, **options,
    )
    return Pipeline(stages=[*plan.encoder(), trees]).fit(filled)


def errors_by_round(model: PipelineModel, plan: FeaturePlan, splits: dict[str, DataFrame]) -> DataFrame:
    """``(split, round, squared_error)``: the mean squared error of each split after each round."""
    spark = SparkSession.active()
    encoder, trees = PipelineModel(stages=model.stages[:-1]), model.stages[-1]
    rows = [
        (name, number, float(error))
        for name, frame in splits.items()
        for number, error in enumerate(trees.evaluateEachIteration(encoder.transform(plan.fill(frame)), "squared"), 1)
    ]
    return spark.createDataFrame(rows, "split string, round int, squared_error double")


def split_stats(plan: FeaturePlan, splits: dict[str, DataFrame]) -> DataFrame:
    """Labelled rows and mean label per split."""
    rows = [
        plan.fill(frame).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(plan.label).alias("label_mean")).select(F.lit(name).alias("split"), "*")
        for name, frame in splits.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def scores(model: PipelineModel, plan: FeaturePlan, splits: dict[str, DataFrame]) -> DataFrame:
    """Rows, mean label and root mean squared error per split."""
    error = F.col(plan.label) - F.col("prediction")
    rows = [
        model.transform(plan.fill(frame))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(plan.label).alias("label_mean"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
        )
        .select(F.lit(name).alias("split"), "*")
        for name, frame in splits.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def split_counts(model: PipelineModel, plan: FeaturePlan, path: str) -> DataFrame:
    """How many splits of the fitted trees use each feature. Features that no tree uses are absent.

    The trees are saved to ``path`` and counted from there as a table of nodes.
    """
    spark = SparkSession.active()
    trees = model.stages[-1]
    trees.write().overwrite().save(path)
    saved = spark.read.parquet(f"{path}/data")
    try:
        nodes = saved.select(F.col("nodeData.split.featureIndex").alias("i"))
    except AnalysisException as missing:
        raise RuntimeError("this Spark version saves trees in another layout; splits cannot be counted") from missing
    names = F.array(*[F.lit(feature) for _, feature in plan.inputs])
    return (
        nodes.where(F.col("i") >= 0)
        .select(F.get(names, F.col("i")).alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("score"))
    )


def top_features(counts: DataFrame, k: int = 40) -> DataFrame:
    return counts.orderBy(F.desc("score"), "feature").limit(k)

