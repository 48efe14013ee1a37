"""Logistic heads over features, fitted with Spark's own estimators."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fit_head(rows: DataFrame, penalty: float = 0.01):
    """A standardised logistic regression with ridge penalty over rows (x, y, weight)."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    head = LogisticRegression(featuresCol="scaled", labelCol="y", weightCol="weight", regParam=penalty, elasticNetParam=0.0, standardization=False, maxIter=50)
    return Pipeline(stages=[scaler, head]).fit(rows.withColumn("features", array_to_vector(F.col("x").cast("array<double>"))))


def balanced(rows: DataFrame) -> DataFrame:
    """Adds weight, such that both labels weigh as much."""
    counts = rows.groupBy("y").agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"), F.count("*").alias("_k"))
    shares = counts.join(F.broadcast(total), F.lit(True)).select("y", (F.col("_all") / (F.col("_k") * F.col("_n"))).alias("weight"))  # a row a label
    return rows.join(F.broadcast(shares), "y")


def out_of_fold(rows: DataFrame, folds: int) -> DataFrame:
    """(vec_id, fold, y, p): the probability that a head fitted on the other folds gives to each row (vec_id, x, y, fold).
    A fold whose others have one label only gets that label's."""
    out: DataFrame | None = None
    for k in range(folds):
        train, test = rows.where(F.col("fold") != k), rows.where(F.col("fold") == k)
        labels = [r.y for r in train.select("y").distinct().limit(3).collect()]
        if len(labels) < 2:
            scored = test.select("vec_id", "fold", "y", F.lit(float(labels[0]) if labels else 0.5).alias("p"))
        else:
            model = fit_head(balanced(train))
            scored = model.transform(test.withColumn("features", array_to_vector(F.col("x").cast("array<double>")))).select("vec_id", "fold", "y", vector_to_array("probability")[1].alias("p"))
        out = scored if out is None else out.unionByName(scored)
    return out


def pool_frames(frames: DataFrame, key: str, order: str, vector: str, edge: int) -> DataFrame:
    """(key, i, mean, std, start_edge, end_edge): over a key's frames in order, for each dimension i the mean and spread of all, and
    the means of the first and last `edge` of them (of all, where there are fewer)."""
    rank = lambda o: F.row_number().over(Window.partitionBy(key).orderBy(o))
    each = lambda rows, *names: rows.select(key, F.posexplode(vector).alias("i", "_x")).groupBy(key, "i").agg(*[f(F.col("_x").cast("double")).alias(n) for f, n in names])
    whole = each(frames, (F.avg, "mean"), (F.stddev_pop, "std"))
    first, last = (each(frames.withColumn("_n", rank(o)).where(F.col("_n") <= edge), (F.avg, n)) for o, n in ((F.col(order), "start_edge"), (F.desc(order), "end_edge")))
    return whole.join(first, [key, "i"]).join(last, [key, "i"])


#: What the modes put side by side.
MODES = {"mean": ("mean",), "mean_std": ("mean", "std"), "edge": ("start_edge", "end_edge"), "combined": ("mean", "std", "start_edge", "end_edge")}


def feature_matrix(pooled: DataFrame, key: str) -> DataFrame:
    """(key, mode, place, x): the pooled values of each key (see pool_frames()) as one vector by mode."""
    parts = ("mean", "std", "start_edge", "end_edge")
    row = F.array_sort(F.collect_list(F.struct("i", *parts)))  # a row a dimension
    gathered = pooled.groupBy(key).agg(row.alias("_r")).select(key, *[F.col(f"_r.{p}").alias(p) for p in parts])
    vectors = F.create_map(*[x for mode, names in MODES.items() for x in (F.lit(mode), F.concat(*names))])
    return gathered.select(key, F.explode(vectors).alias("mode", "_v")).select(key, "mode", F.posexplode("_v").alias("place", "x"))
