"""Feature selection, clustering quality and label indexing (M1-M3) with
Spark ML's current estimators; all fitting is distributed by Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StringIndexer, UnivariateFeatureSelector
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A label index is a table of labels in every task: at most this many a column.
MAX_LABELS = 1_000_000


def as_vectors(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """array<float|double> -> ML vector column (JVM expression)."""
    return df.withColumn(out, array_to_vector(F.col(array_col)))


def select_features(df: DataFrame, features: str, label: str, k: int,
                    feature_type: str = "continuous", label_type: str = "categorical",
                    out: str = "selected") -> tuple[DataFrame, list[int]]:
    """M1: keep the ``k`` features that score best against the label
    (ANOVA F for continuous features and categorical label; chi-squared when
    both are categorical)."""
    selector = (UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=out,
                                          selectionMode="numTopFeatures")
                .setFeatureType(feature_type).setLabelType(label_type)
                .setSelectionThreshold(k))
    model = selector.fit(df)
    return model.transform(df), list(model.selectedFeatures)


def fit_clusters(df: DataFrame, features: str, k: int, seed: int = 7):
    """M2: a bisecting k-means model.  The estimator persists its own vectors
    while iterating when the input is not cached, so no cache is added here
    (measured: an extra one only costs time)."""
    return BisectingKMeans(featuresCol=features, k=k, seed=seed).fit(df)


def silhouette(assigned: DataFrame, features: str) -> float:
    """M2: silhouette of an assignment (ClusteringEvaluator)."""
    return float(ClusteringEvaluator(featuresCol=features,
                                     predictionCol="prediction").evaluate(assigned))


def clustering_cost(model, df: DataFrame, features: str) -> float:
    """M2: cost of a fitted clustering on any dataset -- the sum of squared
    distances to the centre of the assigned cluster, in one partial aggregate
    (the centres are a constant of k vectors)."""
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    gaps = F.zip_with(vector_to_array(F.col(features)),
                      F.get(centres, F.col("prediction")), lambda a, b: (a - b) * (a - b))
    cost = F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x)
    return float(model.transform(df).agg(F.coalesce(F.sum(cost), F.lit(0.0))).first()[0])


def index_labels(df: DataFrame, columns: Sequence[str], suffix: str = "_idx",
                 order: str = "frequencyDesc", max_labels: int = MAX_LABELS
                 ) -> tuple[DataFrame, list[list[str]]]:
    """M3: one StringIndexer over several columns; index 0 is the most
    frequent value, ties broken alphabetically.  Returns the indexed frame
    and ``labelsArray``.

    The fitted model holds every distinct label, on the driver and in each
    task: columns are counted first, and more than ``max_labels`` of one raise.
    """
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    over = {c: counts[c] for c in columns if counts[c] > max_labels}
    if over:
        raise ValueError(f"more than {max_labels} labels: {over}")
    indexer = StringIndexer(inputCols=list(columns),
                            outputCols=[f"{c}{suffix}" for c in columns],
                            stringOrderType=order, handleInvalid="keep")
    model = indexer.fit(df)
    return model.transform(df), [list(a) for a in model.labelsArray]
