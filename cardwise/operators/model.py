"""Boosted-tree training and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwise.schema import FEATURE_ORDER

ROUNDTRIP_TOLERANCE = 1e-5


def require_features(df: DataFrame, names: Sequence[str] = FEATURE_ORDER) -> None:
    """Fail with the list of missing feature columns (schema check, no job)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing feature column(s): {missing}")


def model_vector(df: DataFrame, out_col: str = "features_vec") -> DataFrame:
    """Dense vector in FEATURE_ORDER, values rounded to float32 as at fit time."""
    require_features(df)
    f32 = df.select("*", *[F.col(n).cast("float").cast("double").alias(f"_f32_{n}") for n in FEATURE_ORDER])
    va = VectorAssembler(inputCols=[f"_f32_{n}" for n in FEATURE_ORDER], outputCol=out_col, handleInvalid="keep")
    return va.transform(f32).drop(*[f"_f32_{n}" for n in FEATURE_ORDER])


def train(
    train_df: DataFrame,
    valid_df: DataFrame,
    seed: int = 42,
    max_iter: int = 200,
    max_depth: int = 6,
    step: float = 0.05,
    early_stop: bool = True,
) -> GBTClassificationModel:
    """L1: binary boosted trees; positives weighted (n - pos) / pos; by default growth stops early
    on the validation rows' loss (:mod:`cardwise.operators.boosting` chooses by average precision)."""
    counts = train_df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("pos")).first()
    pos = max(int(counts["pos"]), 1)
    w_pos = (int(counts["n"]) - pos) / pos
    both = train_df.withColumn("_is_valid", F.lit(False))
    if early_stop:
        both = both.unionByName(valid_df.withColumn("_is_valid", F.lit(True)))
    both = model_vector(both).withColumn(
        "_w", F.when(F.col("label") == 1, F.lit(float(w_pos))).otherwise(F.lit(1.0))
    ).withColumn("label", F.col("label").cast("double"))
    gbt = GBTClassifier(
        featuresCol="features_vec",
        labelCol="label",
        weightCol="_w",
        **({"validationIndicatorCol": "_is_valid"} if early_stop else {}),
        stepSize=step,
        maxIter=max_iter,
        maxDepth=max_depth,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=seed,
    )
    return gbt.fit(both)


def score(df: DataFrame, model: GBTClassificationModel, out_col: str = "score") -> DataFrame:
    """L3: P(fraud) in [0, 1] per row (vectorised ``transform``)."""
    scored = model.transform(model_vector(df))
    return scored.withColumn(out_col, vector_to_array("probability")[1]).drop(
        "features_vec", "rawPrediction", "probability", "prediction"
    )


def verify_model_roundtrip(model: GBTClassificationModel, df: DataFrame, path: str) -> float:
    """L2: save, reload, score both; fail when they differ by more than 1e-5."""
    model.write().overwrite().save(path)
    again = GBTClassificationModel.load(path)
    a = score(df.select("txn_id", *FEATURE_ORDER), model, "a")
    b = score(df.select("txn_id", *FEATURE_ORDER), again, "b")
    diff = a.join(b.select("txn_id", "b"), "txn_id").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    diff = float(diff or 0.0)
    if diff > ROUNDTRIP_TOLERANCE:
        raise RuntimeError(f"reloaded model differs: max |a - b| = {diff:g} > {ROUNDTRIP_TOLERANCE:g}")
    return diff


def feature_importance(model: GBTClassificationModel) -> DataFrame:
    """(feature, importance) sorted by importance, descending (27 rows)."""
    spark = model.sparkSession if hasattr(model, "sparkSession") else None
    from pyspark.sql import SparkSession

    spark = spark or SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    rows = list(zip(FEATURE_ORDER, [float(x) for x in imp]))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
