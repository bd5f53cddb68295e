"""Label indexing, random forest, confusion matrix and the metrics read off it."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions import rules
from featureflow.functions.vectors import require_vector
from featureflow.operators.classes import class_counts
from featureflow.operators.numbering import running_total
from featureflow.sources.settle import lay_out

# Forest settings.
MAX_DEPTH = 10
NUM_TREES = 50
SEED = 42

AGGREGATION_MB = 1024


def label_index(df: DataFrame, label: str = "label") -> DataFrame:
    """Class table ``label, n, label_indexed``: index 0 for the most frequent, ties by label text, nulls left out.

    The same numbers as the classifier's indexer gives. The class table is sorted by ranges and numbered by the
    sizes of the sorted partitions, so no task has to hold it.
    """
    counts = class_counts(df.filter(F.col(label).isNotNull()), label).withColumn("__one", F.lit(1).cast("long"))
    place = running_total(counts, [], [F.col("n").desc(), F.col(label).cast("string")], "__one", "__place")
    return place.select(label, "n", (F.col("__place") - 1).cast("double").alias("label_indexed"))


def train_classifier(
    df: DataFrame, label: str = "label", features: str = "features_pca", max_depth: int = MAX_DEPTH,
    num_trees: int = NUM_TREES, seed: int = SEED, handle_invalid: str = "error", key: str | None = None,
    partitions: int | None = None, memory_mb: int = AGGREGATION_MB,
) -> PipelineModel:
    """Fit label indexer + random forest. ``handle_invalid`` (error, keep, skip) is for labels unseen in training.

    With a ``key`` the rows are laid out by it first, which makes the forest independent of the input's splits.
    ``memory_mb`` bounds the split statistics of one pass: components x bins x classes x 8 bytes per tree node.
    More memory means more nodes per pass, so fewer passes over the rows.
    """
    require_vector(df, features)
    df = df.select(*{label: None, features: None, **({key: None} if key else {})})
    if key is not None:
        df = lay_out(df, key, partitions)
    indexer = StringIndexer(inputCol=label, outputCol="label_indexed", handleInvalid=handle_invalid)
    forest = RandomForestClassifier(
        labelCol="label_indexed", featuresCol=features, maxDepth=max_depth, numTrees=num_trees, seed=seed,
        maxMemoryInMB=memory_mb,
    )
    return Pipeline(stages=[indexer, forest]).fit(df)


def predict(model: PipelineModel, df: DataFrame, output: str = "predicted_label") -> DataFrame:
    """Adds label_indexed, rawPrediction, probability, prediction, and the prediction as label text."""
    back = IndexToString(inputCol="prediction", outputCol=output, labels=model.stages[0].labels)
    return back.transform(model.transform(df))


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Non-empty cells ``actual, predicted, n``; one partial aggregate, one small shuffle."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    df: DataFrame, actual: str = "label", predicted: str = "predicted_label", dense: bool = False
) -> DataFrame:
    """Cells ``actual, predicted, n`` of rows with both labels; with ``dense`` also the empty ones.

    A dense matrix has classes x classes cells over the labels seen on either side, by definition.
    """
    cells = confusion_counts(df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()), actual, predicted)
    if not dense:
        return cells
    cells = confusion_counts(df, actual, predicted)
    labels = cells.select(F.explode(F.array("actual", "predicted")).alias("c")).filter(F.col("c").isNotNull()).distinct()
    every = labels.agg(F.collect_list("c")).scalar()
    grid = labels.select(F.col("c").alias("actual"), F.explode(every).alias("predicted"))
    return grid.join(cells, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def class_metrics(df: DataFrame, actual: str = "label", predicted: str = "predicted_label") -> DataFrame:
    """One row: accuracy and class-size weighted F1, precision and recall, all from the confusion cells.

    Rows with a null on either side are left out. A class that is never predicted has precision 0.
    """
    cells = confusion_counts(df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull()), actual, predicted)
    cells = cells.withColumn("hit", F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)))
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("c"), F.col("n").alias("n_actual"), F.lit(0).cast("long").alias("n_predicted"), "hit"),
                F.struct(F.col("predicted").alias("c"), F.lit(0).cast("long").alias("n_actual"), F.col("n").alias("n_predicted"), F.lit(0).cast("long").alias("hit")),
            )
        )
    )
    per_class = sides.groupBy("c").agg(
        F.sum("n_actual").alias("n_actual"), F.sum("n_predicted").alias("n_predicted"), F.sum("hit").alias("hit")
    )
    zero = F.lit(0.0)
    precision = F.coalesce(rules.ratio(F.col("hit"), F.col("n_predicted")), zero)
    recall = F.coalesce(rules.ratio(F.col("hit"), F.col("n_actual")), zero)
    scored = per_class.withColumn("p", precision).withColumn("r", recall).withColumn(
        "f", F.coalesce(rules.ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), zero)
    )
    weighted = lambda c: rules.ratio(F.sum(F.col(c) * F.col("n_actual")), F.sum("n_actual"))
    return scored.agg(
        rules.ratio(F.sum("hit"), F.sum("n_actual")).alias("accuracy"),
        weighted("f").alias("f1_score"),
        weighted("p").alias("precision"),
        weighted("r").alias("recall"),
    )


def evaluate_classifier(model: PipelineModel, df: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(metrics, predictions)."""
    predictions = predict(model, df)
    return class_metrics(predictions, label, "predicted_label"), predictions
