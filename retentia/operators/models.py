"""Churn model and customer segments with Spark ML (M6, M8, M13, M19 registry, M21, M22).

Training is Spark ML's distributed implementations: gradient-boosted trees aggregate split statistics per tree level
across executors, k-means runs its assignment step distributed. Scoring is a narrow ``transform``; the fitted model
travels to executors by broadcast. Centroid distances are JVM-side higher-order array functions, no Python UDF.
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentia.operators.common import stored
from retentia.operators.features import CHURN_FEATURES, CLUSTER_FEATURES, LABEL, class_weights, split_train_eval
from retentia.operators.reports import PRED, PROB, churn_predictions
from retentia.session import ensure_checkpoint_dir
from retentia.sources.bronze import replace_partitions

# Reference options -> Spark ML parameters. l1/l2 regularisation has no GBTClassifier counterpart.
CHURN_MODEL_PARAMS = dict(maxDepth=4, subsamplingRate=0.8, minInstancesPerNode=1, maxIter=20, stepSize=0.3,
                          validationTol=0.01, maxBins=32)
SEGMENT_PARAMS = dict(k=5, maxIter=20, initMode="k-means||")
#: Rows that a k-means task keeps and reads at every step.
SEGMENT_ROWS_PER_TASK = 50_000


# ------------------------------------------------------------------------------------------------- churn model
def fit_churn_model(training: DataFrame, eval_fraction: float = 0.2, seed: int = 42,
                    features: list[str] = CHURN_FEATURES, **params) -> PipelineModel:
    """M6. Boosted trees on the training set with inverse-frequency class weights; the hash-split evaluation rows
    drive early stopping (``validationIndicatorCol``) and are not trained on."""
    df = class_weights(split_train_eval(training, eval_fraction, seed))
    gbt = GBTClassifier(featuresCol="features", labelCol=LABEL, weightCol="class_weight",
                        validationIndicatorCol="is_eval", seed=seed, **{**CHURN_MODEL_PARAMS, **params})
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, gbt]).fit(df.withColumn(LABEL, F.col(LABEL).cast("double")))


def positive_probability(model_output: DataFrame) -> Column:
    """Probability of label 1.0 (index 1 of Spark's probability vector)."""
    return vector_to_array(F.col("probability")).getItem(1)


def predict_churn(model: PipelineModel, scoring: DataFrame) -> DataFrame:
    """M8 + M9. ``transform`` keeps the input columns, so no join back to the scoring table is needed."""
    out = model.transform(scoring)
    return churn_predictions(out, positive_probability(out), F.col("prediction"))


def evaluation_predictions(model: PipelineModel, training: DataFrame, eval_fraction: float = 0.2,
                           seed: int = 42) -> DataFrame:
    """The held-out rows of the training split, scored (input of ``reports.evaluate``)."""
    held_out = split_train_eval(training, eval_fraction, seed).where("is_eval")
    out = model.transform(held_out)
    return out.select(LABEL, positive_probability(out).alias(PROB), F.col("prediction").cast("long").alias(PRED))


def _gbt(model: PipelineModel) -> GBTClassificationModel:
    return next(s for s in model.stages if isinstance(s, GBTClassificationModel))


def feature_importance(model: PipelineModel, features: list[str] = CHURN_FEATURES,
                       model_dir: str | None = None) -> DataFrame:
    """M13. Per feature: split count (weight), mean split gain (gain), mean rows reaching the split (cover).

    The split table is read from the saved model's node data with Spark. That layout is Spark's own persistence
    format, so it is checked here; an unknown layout is an error.
    """
    spark = SparkSession.builder.getOrCreate()  # the session that holds the model
    gbt = _gbt(model)
    base = model_dir or os.path.join(ensure_checkpoint_dir(spark), f"gbt-{uuid.uuid4().hex}")
    gbt.write().overwrite().save(base)
    nodes = spark.read.parquet(os.path.join(base, "data"))
    names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "fi int, feature string")
    node_fields = {f.name for f in nodes.schema["nodeData"].dataType.fields} if "nodeData" in nodes.columns else set()
    split_fields = set()
    if "split" in node_fields:
        split_fields = {f.name for f in nodes.schema["nodeData"].dataType["split"].dataType.fields}
    if not ({"gain", "rawCount", "split"} <= node_fields and "featureIndex" in split_fields):
        raise ValueError(f"unknown layout of saved tree nodes: {nodes.schema.simpleString()}")
    splits = (nodes.select(F.col("nodeData.split.featureIndex").alias("fi"), F.col("nodeData.gain").alias("g"),
                           F.col("nodeData.rawCount").alias("c"))
              .where(F.col("fi") >= 0)
              .groupBy("fi").agg(F.count(F.lit(1)).cast("double").alias("importance_weight"),
                                 F.avg("g").alias("importance_gain"),
                                 F.avg(F.col("c").cast("double")).alias("importance_cover")))
    return (names.join(F.broadcast(splits), "fi", "left")
            .select("feature", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c)
                                 for c in ["importance_weight", "importance_gain", "importance_cover"]]))


# ---------------------------------------------------------------------------------------------- model registry
REGISTRY_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("model_type", T.StringType()),
    T.StructField("creation_time", T.TimestampType()), T.StructField("location", T.StringType()),
    T.StructField("training_run", T.ArrayType(T.StructType([
        T.StructField("start_time", T.TimestampType()),
        T.StructField("input_feature_columns", T.ArrayType(T.StringType())),
        T.StructField("options", T.MapType(T.StringType(), T.StringType()))]))),
])


def registry_entry(training: DataFrame, model_name: str, model_type: str, location: str,
                   features: list[str], created: str | None = None, options: dict | None = None) -> DataFrame:
    """One registry row describing a training run over ``training`` (feature columns checked against it)."""
    missing = [f for f in features if f not in training.columns]
    if missing:
        raise ValueError(f"features not in the training table: {missing}")
    ts = F.current_timestamp() if created is None else F.lit(created).cast("timestamp")
    opts = F.create_map(*[x for k, v in sorted((options or {}).items()) for x in (F.lit(k), F.lit(str(v)))]) \
        if options else F.create_map().cast("map<string,string>")
    counted = training.agg(F.count(F.lit(1)).alias("n"))  # one row, whatever the table holds
    opts = F.map_concat(opts, F.create_map(F.lit("training_rows"), F.col("n").cast("string")))
    run = F.struct(ts.alias("start_time"), F.array(*[F.lit(f) for f in features]).alias("input_feature_columns"),
                   opts.alias("options"))
    return (counted.select(F.lit(model_name).alias("model_name"), F.lit(model_type).alias("model_type"),
                                     ts.alias("creation_time"), F.lit(location).alias("location"),
                                     F.array(run).alias("training_run")))


def register_run(entry: DataFrame, path: str) -> DataFrame:
    """M19. Adds the run of ``entry`` (see ``registry_entry``) to its model's row in the registry stored at ``path``; the whole registry.

    The registry has one row per model with all its runs in order of time. The row is read, extended and put in place of the old one
    (a partition of its own); runs with one start time are one run, so a repeated registration changes nothing. Type, creation time and
    location stay those of the first run. One writer at a time.
    """
    spark = entry.sparkSession
    name = entry.first()["model_name"]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    rows = entry
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        old = spark.read.schema(REGISTRY_SCHEMA).parquet(path).where(F.col("model_name") == name)
        rows = old.unionByName(entry)
    first = F.min_by(F.struct("model_type", "creation_time", "location"), "creation_time").alias("first")
    about = rows.groupBy("model_name").agg(first)
    runs = rows.select("model_name", F.explode("training_run").alias("run")).groupBy("model_name", F.col("run.start_time").alias("at")).agg(F.first("run").alias("run"))
    listed = runs.groupBy("model_name").agg(F.array_sort(F.collect_list("run"), lambda a, b: F.when(a["start_time"] < b["start_time"], -1)
                                                         .when(a["start_time"] > b["start_time"], 1).otherwise(0)).alias("training_run"))
    merged = stored(about.join(listed, "model_name").select("model_name", "first.*", "training_run"), "registry-row")
    replace_partitions(merged, path, ["model_name"])
    return spark.read.schema(REGISTRY_SCHEMA).parquet(path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def utc_now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


# --------------------------------------------------------------------------------------------------- segments
def fit_segments(df: DataFrame, features: list[str] = CLUSTER_FEATURES, seed: int = 42, **params) -> PipelineModel:
    """M21. Mean imputation -> standardisation (mean and sample std) -> k-means (k = 5, k-means|| start)."""
    imputed = [f"{c}__imp" for c in features]
    stages = [
        Imputer(strategy="mean", inputCols=features, outputCols=imputed),
        VectorAssembler(inputCols=imputed, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        KMeans(featuresCol="features", predictionCol="prediction", seed=seed, **{**SEGMENT_PARAMS, **params}),
    ]
    cast = spread(df).select(*[F.col(c).cast("double").alias(c) if c in features else F.col(c) for c in df.columns])
    return Pipeline(stages=stages).fit(cast)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in tasks of about ``SEGMENT_ROWS_PER_TASK`` rows, if it has more: one file, however large, may else be one task."""
    parts = math.ceil(df.count() / SEGMENT_ROWS_PER_TASK)
    return df.repartition(parts, *df.columns) if parts > 1 else df


def nearest_centroids(vec: Column, centers: list[list[float]]) -> Column:
    """Array of (centroid_id, distance) sorted by distance, ids from 1; ``vec`` is an array<double> column.

    Centers are a literal array (k x d values, bounded by the model size).
    """
    lit_centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    with_id = F.arrays_zip(F.sequence(F.lit(1), F.lit(len(centers))).alias("centroid_id"),
                           lit_centers.alias("center"))
    dist = F.transform(with_id, lambda e: F.struct(
        e["centroid_id"].cast("long").alias("centroid_id"),
        F.sqrt(F.aggregate(F.zip_with(vec, e["center"], lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                           lambda acc, x: acc + x)).alias("distance")))
    return F.array_sort(dist, lambda l, r: F.when(l["distance"] < r["distance"], -1)
                        .when(l["distance"] > r["distance"], 1)
                        .otherwise((l["centroid_id"] - r["centroid_id"]).cast("int")))


def assign_segments(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M22. Client, four features, assigned cluster (from 1), nearest cluster and its distance."""
    km = next(s for s in model.stages if isinstance(s, KMeansModel))
    cast = df.select(*[F.col(c).cast("double").alias(c) if c in CLUSTER_FEATURES else F.col(c) for c in df.columns])
    out = model.transform(cast)
    near = nearest_centroids(vector_to_array(F.col("features")), [c.tolist() for c in km.clusterCenters()])
    return segment_assignment(out.withColumn("__near", near), (F.col("prediction") + 1).cast("long"))


def segment_assignment(df: DataFrame, cluster_id: Column) -> DataFrame:
    """Output shape of M22 from a frame with ``__near`` (sorted centroid distances) and a cluster id column."""
    return df.select("cliente_id", "dias_desde_ultima_compra", "num_compras_6m", "valor_compras_6m",
                     "engagement_score", cluster_id.alias("cluster_id"),
                     F.col("__near").getItem(0).getField("centroid_id").alias("nearest_cluster"),
                     F.col("__near").getItem(0).getField("distance").alias("distance_to_centroid"))


def zscores(df: DataFrame, features: list[str] = CLUSTER_FEATURES, out: str = "__z") -> DataFrame:
    """Add an array of z-scores with mean imputation (NULL -> 0) computed from one-row mean / sample-std aggregates
    joined by broadcast. Same arithmetic as the model pipeline's Imputer + StandardScaler, written out so it can be
    checked exactly against SQL."""
    stats = df.agg(*[F.avg(c).alias(f"__m{i}") for i, c in enumerate(features)],
                   *[F.stddev_samp(c).alias(f"__s{i}") for i, c in enumerate(features)])
    z = F.array(*[F.coalesce(F.try_divide(F.col(c).cast("double") - F.col(f"__m{i}"), F.col(f"__s{i}")), F.lit(0.0))
                  for i, c in enumerate(features)])
    return (df.crossJoin(F.broadcast(stats)).withColumn(out, z)
            .drop(*[f"__m{i}" for i in range(len(features))], *[f"__s{i}" for i in range(len(features))]))
