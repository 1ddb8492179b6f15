"""Sampling, splitting, metrics, and the learned quality filter."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.dialogue import number_rows


def sample_k(df: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """``min(k, rows)`` rows in the order of a seeded hash; each task keeps its best ``k`` only."""
    return df.orderBy(F.sha2(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))), 256), key).limit(k)


def split_sets(df: DataFrame, key: str, train: float = 0.7, validation: float = 0.15, seed: int = 42) -> DataFrame:
    """Rows with ``part`` (train, validation, test): exact shares of the seeded hash order."""
    if train + validation >= 1 or train <= 0 or validation < 0:
        raise ValueError("the shares must leave something to test on")
    hashed = df.withColumn("__hash", F.sha2(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))), 256))
    numbered = number_rows(hashed, ["__hash", key])
    total = numbered.agg(F.count(F.lit(1)).alias("total"))
    share = (F.col("row_no") + 1) / total.scalar()
    part = F.when(share <= train, "train").when(share <= train + validation, "validation").otherwise("test")
    return numbered.withColumn("part", part).drop("__hash", "row_no")


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def weighted_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 weighted by label counts."""
    cells = confusion_matrix(df, label, prediction)
    by_label = cells.groupBy("label").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hits"))
    by_prediction = cells.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    each = by_label.join(by_prediction, "label", "left").na.fill(0, ["predicted"])
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.col("hits") / F.col("support")
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    scored = each.select("support", "hits", precision.alias("p"), recall.alias("r"), f1.alias("f"))
    weight = lambda c: (F.sum(F.col("support") * F.col(c)) / F.sum("support"))
    return scored.agg((F.sum("hits") / F.sum("support")).alias("accuracy"), weight("p").alias("weighted_precision"), weight("r").alias("weighted_recall"), weight("f").alias("weighted_f1"))


def retention(df: DataFrame, kept: Column) -> DataFrame:
    """One row: total, retained and the retained share in per cent (0 for no rows)."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(kept.cast("bigint")), F.lit(0)).alias("retained")).withColumn("retained_pct", F.coalesce(F.try_divide(F.col("retained") * 100.0, F.col("total")), F.lit(0.0)))


def train_filter(lines: DataFrame, line_column: str = "line", label_column: str = "label", *, features: int = 1 << 16, max_iter: int = 30, reg: float = 1e-3) -> PipelineModel:
    """A text classifier over hashed words and characters; rows without a 0/1 label are left out."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    data = lines.where(F.col(label_column).isin(0, 1)).withColumn(label_column, F.col(label_column).cast("double"))
    stages = [
        RegexTokenizer(inputCol=line_column, outputCol="__words", pattern=r"[\p{IsHan}]|[^\s\p{IsHan}\p{Punct}]+", gaps=False),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=features),
        IDF(inputCol="__tf", outputCol="__features"),
        LogisticRegression(featuresCol="__features", labelCol=label_column, maxIter=max_iter, regParam=reg),
    ]
    return Pipeline(stages=stages).fit(data)


def apply_filter(model: PipelineModel, lines: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows with their probability of being good; those below the threshold are dropped."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(lines).withColumn("score", vector_to_array("probability")[1])
    drop = [c for c in ("__words", "__tf", "__features", "rawPrediction", "probability", "prediction") if c in scored.columns]
    return scored.drop(*drop).where(F.col("score") >= threshold)
