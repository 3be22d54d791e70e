"""M1-M3 on the embeddings and events tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sluice.operators import features as M
from sluice.plans.tables import table


def test_feature_selection_and_clusters(spark):
    emb = M.as_vectors(table(spark, SF_SMALL, "embeddings"), "embedding")
    out, picked = M.select_features(emb, "features", "label", 8)
    assert len(picked) == 8 and out.count() == emb.count()
    model = M.fit_clusters(emb, "features", 3)
    assigned = model.transform(emb)
    assert -1.0 <= M.silhouette(assigned, "features") <= 1.0
    assert assigned.select("prediction").distinct().count() <= 3
    # the cost of any dataset; on the fitted one it is the training cost
    cost = M.clustering_cost(model, emb, "features")
    assert abs(cost - model.summary.trainingCost) < 1e-6 * cost
    assert M.clustering_cost(model, emb.limit(0), "features") == 0.0


def test_too_many_labels_raise(spark):
    import pytest
    df = spark.createDataFrame([(str(i), "x") for i in range(20)], "c string, d string")
    with pytest.raises(ValueError, match="more than 10 labels"):
        M.index_labels(df, ["c", "d"], max_labels=10)
    assert len(M.index_labels(df, ["c", "d"], max_labels=20)[1][0]) == 20


def test_label_index_order(spark):
    df = spark.createDataFrame([(v,) for v in "bbbaaaccd"], "c string")
    indexed, labels = M.index_labels(df, ["c"])
    assert labels == [["a", "b", "c", "d"]]
    got = {r["c"]: r["c_idx"] for r in indexed.distinct().collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}
    assert indexed.where(F.col("c_idx").isNull()).count() == 0


def test_chi_squared_selection(spark):
    from pyspark.ml.linalg import Vectors
    # feature 1 determines the label, features 0 and 2 are noise
    rows = [(Vectors.dense([float(i % 3), float(i % 2), float((i // 2) % 2)]), float(i % 2))
            for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "label"])
    _, picked = M.select_features(df, "features", "label", 1,
                                  feature_type="categorical", label_type="categorical")
    assert picked == [1]
