"""L1: the best iteration of a boosted ensemble by average precision on validation rows.

All prefixes of an ensemble are scored in one pass: each row's margin after every tree, from the
trees' node tables (trees x nodes of one tree, which the model's parameters bound). Average
precision of every prefix then comes from one range-partitioned sort of (iteration, score) with
running counts. The kept model is the saved ensemble without the trees after the best one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.operators.model import require_features, train
from cardwise.operators.ordered import segmented_prefix
from cardwise.schema import FEATURE_ORDER
from cardwise.session import scratch_path

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def saved(model: GBTClassificationModel, spark: SparkSession) -> str:
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    return path


def node_tables(spark: SparkSession, model: GBTClassificationModel) -> list[tuple[float, Tree]]:
    """(weight, (feature, threshold, left, right, value)) of each tree, from the saved model."""
    path = saved(model, spark)
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}  # a row a tree
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").toPandas()
    out = []
    for tree, rows in nodes.groupby("treeID"):
        split = [(s["featureIndex"], s["leftCategoriesOrThreshold"][0] if s["featureIndex"] >= 0 else 0.0) for s in rows["split"]]
        feature, threshold = np.array([f for f, _ in split]), np.array([t for _, t in split])
        out.append((weights[tree], (feature, threshold, rows["leftChild"].to_numpy(), rows["rightChild"].to_numpy(), rows["prediction"].to_numpy())))
    return out


def first_trees(spark: SparkSession, model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model with its first ``n`` trees."""
    path, short = saved(model, spark), scratch_path(spark, "trees")
    spark.read.parquet(f"{path}/data").where(F.col("treeID") < n).write.parquet(f"{short}/data")
    spark.read.parquet(f"{path}/treesMetadata").where(F.col("_1") < n).write.parquet(f"{short}/treesMetadata")
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0]) | {"numTrees": n}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{short}/metadata")
    return GBTClassificationModel.load(short)


def predicted(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The tree's value for each row of ``x``."""
    feature, threshold, left, right, value = tree
    at = np.zeros(len(x), np.int64)
    while (inner := np.flatnonzero(feature[at] >= 0)).size:
        node = at[inner]
        at[inner] = np.where(x[inner, feature[node]] <= threshold[node], left[node], right[node])
    return value[at]


def prefix_scores(df: DataFrame, model: GBTClassificationModel) -> DataFrame:
    """(txn_id, ts_ms, label, iteration, score) for every number of trees from 1 on."""
    require_features(df)
    trees = node_tables(df.sparkSession, model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[list(FEATURE_ORDER)].to_numpy(np.float32).astype(np.float64)
            margin = np.zeros(len(pdf))
            for i, (weight, tree) in enumerate(trees, 1):
                margin = margin + weight * predicted(tree, x)
                yield pdf[["txn_id", "ts_ms", "label"]].assign(iteration=i, score=1 / (1 + np.exp(-2 * margin)))

    rows = df.select("txn_id", "ts_ms", F.col("label").cast("long").alias("label"), *FEATURE_ORDER)
    return rows.mapInPandas(run, "txn_id string, ts_ms long, label long, iteration int, score double")


def precision_by_iteration(df: DataFrame, model: GBTClassificationModel) -> DataFrame:
    """(iteration, average_precision), the A11 of every prefix."""
    rows = prefix_scores(df, model).withColumn("one", F.lit(1).cast("long"))
    ranked = segmented_prefix(rows, ["iteration"], [F.col("score").desc(), F.col("ts_ms"), F.col("txn_id")], ["one", "label"])
    hit = F.sum(F.when(F.col("label") == 1, F.col("cum_label") / F.col("cum_one")))
    return ranked.groupBy("iteration").agg(F.coalesce(F.try_divide(hit, F.sum("label").cast("double")), F.lit(0.0)).alias("average_precision"))


def train_best(train_df: DataFrame, valid_df: DataFrame, max_iter: int = 200, **options) -> tuple[GBTClassificationModel, int, list[float]]:
    """(model, best iteration, curve): ``max_iter`` trees are grown, and the shortest prefix with
    the highest average precision on ``valid_df`` is kept."""
    grown = train(train_df, valid_df, max_iter=max_iter, early_stop=False, **options)
    curve = [r["average_precision"] for r in precision_by_iteration(valid_df, grown).orderBy("iteration").collect()]  # a row a tree
    best = int(np.argmax(curve)) + 1
    kept = grown if best == len(curve) else first_trees(train_df.sparkSession, grown, best)
    return kept, best, curve
