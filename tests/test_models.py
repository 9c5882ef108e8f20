import pytest
from pyspark.sql import functions as F

from patronage.operators import clusters, models
from patronage.operators.customers import customer_features
from patronage.operators.churn import churn_dataset
from patronage.plans import jobs, modelling
from patronage.session import materialize, scratch_path
from patronage.sources import files
from patronage.sources.shop import load_shop

SMALL = "/root/testdata/sf0.001"
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def prepared(spark):
    return models.prepare(materialize(churn_dataset(load_shop(spark, SMALL))))


@pytest.fixture(scope="module")
def logistic(prepared):
    return models.train_logistic(prepared, [0.1, 1.0], folds=3)


def test_logistic_is_repeatable(prepared, logistic):
    assert models.model_comparison([logistic], prepared).first()["trainAUC"] > 0.55
    again = models.train_logistic(prepared, [0.1, 1.0], folds=3)
    assert again.params == logistic.params and again.cv_auc == logistic.cv_auc


def test_models_find_a_signal(spark):
    """The labels of the test data are unrelated to the features; here one feature decides."""
    dataset = churn_dataset(load_shop(spark, SF_DIR)).withColumn(
        "is_churned", (F.col("payment_value") > 150000).cast("int")
    )
    ready = models.prepare(materialize(dataset))
    found = [models.train_logistic(ready, [100.0], folds=2), models.train_forest(ready, trees=10, depth=4)]
    for row in models.model_comparison(found, ready).collect():
        assert row["testAUC"] > 0.95, row


def test_stored_model_gives_the_same_scores(spark, prepared, logistic):
    path = scratch_path(spark, "test-model")
    models.save_model(logistic, path)
    loaded = models.load_model(logistic, path)
    both = models.score_customers(logistic, prepared).exceptAll(models.score_customers(loaded, prepared))
    assert both.count() == 0


def test_gbt_and_forest(spark, prepared):
    boosted = models.train_gbt(prepared, [{"maxIter": 3, "stepSize": 0.2, "maxDepth": 3}], folds=2)
    forest = models.train_forest(prepared, trees=5, depth=4)
    table = models.model_comparison([boosted, forest], prepared)
    assert table.count() == 2 and table.agg(F.sum("is_best")).first()[0] == 1
    importance = models.feature_importance(forest, prepared, spark).collect()
    assert len(importance) == len(prepared.features)
    assert abs(sum(r["importance"] for r in importance) - 1) < 1e-6


def test_search_draws_are_seeded_and_in_range():
    draws = models.sample_params(models.BOOSTED, 20)
    assert draws == models.sample_params(models.BOOSTED, 20)
    assert all(100 <= d["maxIter"] <= 600 and 0.01 <= d["stepSize"] <= 0.3 and 3 <= d["maxDepth"] <= 12 for d in draws)
    assert all(1e-3 <= d["C"] <= 100 for d in models.sample_params(models.LOGISTIC, 20))


def test_tuning_history(spark, prepared):
    tuned = models.tune_model(prepared, models.LOGISTIC, trials=2, folds=2)
    history = models.trial_history(spark, tuned).collect()
    assert len(history) == 2 and max(r["auc"] for r in history) == tuned.cv_auc


@pytest.fixture(scope="module")
def vectors(spark):
    return clusters.behaviour_vectors(materialize(customer_features(load_shop(spark, SMALL)))).persist()


def test_clusters_are_numbered_by_size(vectors):
    sizes = {r["cluster"]: r["count"] for r in clusters.kmeans_segments(vectors, 4, 2).groupBy("cluster").count().collect()}
    assert list(sorted(sizes)) == [0, 1, 2, 3]
    assert [sizes[k] for k in range(4)] == sorted(sizes.values(), reverse=True)


def test_k_search(vectors):
    table = {r["k"]: r for r in clusters.kmeans_k_search(vectors, 8, [2, 3, 5, 8], n_init=2).collect()}
    assert table[8]["inertia"] < table[2]["inertia"]
    assert all(-1 <= r["silhouette"] <= 1 and r["db_index"] > 0 for r in table.values())


def test_silhouette_equals_all_pairs(spark):
    points = [(0, 0, [0.0, 0.0]), (0, 0, [0.0, 1.0]), (0, 1, [5.0, 5.0]), (0, 1, [6.0, 5.0]), (0, 2, [9.0, 0.0])]
    df = spark.createDataFrame(points, "k int, label int, x array<double>")
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    widths = []
    for i, (_, label, x) in enumerate(points):
        mean = {
            other: [d2(x, p[2]) for j, p in enumerate(points) if p[1] == other and j != i]
            for other in {p[1] for p in points}
        }
        if not mean[label]:
            widths.append(0.0)
            continue
        a = sum(mean[label]) / len(mean[label])
        b = min(sum(v) / len(v) for other, v in mean.items() if other != label)
        widths.append((b - a) / max(a, b))
    row = clusters.cluster_quality(df, 2).first()
    assert abs(row["silhouette"] - sum(widths) / len(widths)) < 1e-9
    assert row["inertia"] == 1.0


def test_quality_in_blocks_of_clusters(spark):
    """More clusters than are sent at once: the same measures."""
    import random

    pick = random.Random(3)
    rows = [(k, i % (k + 5), [pick.gauss(i % (k + 5), 1), pick.gauss(0, 1)]) for k in (2, 9) for i in range(200)]
    rows += [(2, 77, [50.0, 1.0])]
    df = spark.createDataFrame(rows, "k int, label int, x array<double>").cache()
    whole = {r["k"]: r for r in clusters.cluster_quality(df, 2).collect()}
    for r in clusters.cluster_quality(df, 2, at_once=4).collect():
        assert all(abs(r[c] - whole[r["k"]][c]) < 1e-9 for c in ("silhouette", "db_index", "inertia"))


def test_jobs_write_their_outputs(spark):
    data = load_shop(spark, SMALL)
    target = scratch_path(spark, "jobs")
    jobs.build_customer_master(data, f"{target}/master")
    master = spark.read.parquet(f"{target}/master")
    assert master.count() == 150
    jobs.build_segments(master, f"{target}/segments", k=3, n_init=1)
    assert spark.read.parquet(f"{target}/segments/customers").count() == 150
    assert spark.read.json(f"{target}/segments/summary").count() == 3
    jobs.build_churn_dataset(data, f"{target}/churn")
    whole = jobs.load_churn_dataset(spark, f"{target}/churn")
    parts = [jobs.load_churn_dataset(spark, f"{target}/churn", split).count() for split in ("train", "val", "test")]
    assert sum(parts) == whole.count() == 150 and all(parts)


def test_shop_is_read_from_parquet_folders(spark):
    from patronage.operators.customers import rfm_base
    from patronage.sources.shop import read_shop
    from shop_data import order, shop

    folder = scratch_path(spark, "shop")
    for name, table in shop(spark, orders=[order("1", "x", "2018-01-01")]).tables().items():
        table.write.parquet(f"{folder}/{name}")
    assert rfm_base(read_shop(spark, folder).orders).first()["frequency"] == 1


def test_existing_target_is_kept(spark):
    source, target = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    files.write_csv(spark.range(3).selectExpr("cast(id as string) AS product_id"), source)
    assert files.csv_to_parquet(spark, source, target, "product_id string").count() == 3
    other = scratch_path(spark, "csv")
    files.write_csv(spark.range(9).selectExpr("cast(id as string) AS product_id"), other)
    assert files.csv_to_parquet(spark, other, target, "product_id string").count() == 3


def test_modelling_job(spark):
    import json

    target = scratch_path(spark, "modelling")
    small = {"maxIter": 2, "stepSize": 0.1, "maxDepth": 2}
    ranges = {"maxIter": (2, 3), "stepSize": (0.1, 0.3), "maxDepth": (2, 3), "C": (0.1, 10.0)}
    tuned = modelling.run(
        load_shop(spark, SMALL), target, 2, 2, logistic_grid=[1.0], gbt_grid=[small], ranges=ranges
    )
    bundle = json.loads(spark.read.text(f"{target}/dashboard").first()[0])
    assert {"modelComparison", "featureImportance", "optimizationHistory", "thresholdOptimization"} <= set(bundle)
    assert len(bundle["optimizationHistory"]) == 2 and len(bundle["riskSegmentation"]) == 3
    thresholds = [t["threshold"] for t in bundle["thresholdOptimization"]]
    assert bundle["recommendedThreshold"] in thresholds and {0.3, 0.9} <= set(thresholds)
    importances = [f["importance"] for f in bundle["featureImportance"]]
    assert importances == sorted(importances, reverse=True)
    assert spark.read.option("header", True).csv(f"{target}/model_results").count() == 3
    assert models.load_model(tuned, f"{target}/model").model is not None
