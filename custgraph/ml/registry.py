"""Model versions, promotion and scoring: saved pipelines and one small table of rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_populated
from .train import prepared

VERSIONS = "model_name string, version int, path string, classifier string, val_f1_score double, alias string, at timestamp"
CHAMPION = "Champion"


def _versions_path(root: str) -> str:
    return f"{root}/model_versions"


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """All version rows of a registry folder; an unused folder has none."""
    try:
        return spark.read.schema(VERSIONS).parquet(_versions_path(root))
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], VERSIONS)


def champion(versions: DataFrame, model_name: str) -> DataFrame:
    """The row that got the alias last, if any."""
    named = versions.filter((F.col("model_name") == model_name) & (F.col("alias") == CHAMPION))
    return named.orderBy(F.desc("version")).limit(1)


def promotion_decision(candidates: DataFrame, champions: DataFrame) -> DataFrame:
    """Candidates (model_name, version, val_f1_score) with the champion's score and whether
    they replace it: only when strictly better; no champion counts as 0."""
    current = champions.select("model_name", F.col("val_f1_score").alias("champion_f1"))
    joined = candidates.join(current, "model_name", "left")
    score = F.coalesce("champion_f1", F.lit(0.0))
    return joined.withColumn("champion_f1", score).withColumn("promoted", F.col("val_f1_score") > F.col("champion_f1"))


def register(
    spark: SparkSession, root: str, model_name: str, model: PipelineModel, classifier: str, f1: float
) -> bool:
    """Saves a new version; it becomes champion when it beats the current one."""
    versions = read_versions(spark, root)
    last = versions.filter(F.col("model_name") == model_name).agg(F.max("version")).first()[0]
    version = (last or 0) + 1
    path = f"{root}/{model_name}/v{version}"
    model.write().overwrite().save(path)
    row = spark.createDataFrame(
        [(model_name, version, path, classifier, float(f1))],
        "model_name string, version int, path string, classifier string, val_f1_score double",
    )
    promoted = promotion_decision(row, champion(versions, model_name)).first()["promoted"]
    row.select(
        *row.columns, F.lit(CHAMPION if promoted else None).cast("string").alias("alias"), F.current_timestamp().alias("at")
    ).write.mode("append").parquet(_versions_path(root))
    return promoted


def load_champion(spark: SparkSession, root: str, model_name: str) -> PipelineModel | None:
    row = champion(read_versions(spark, root), model_name).first()
    return PipelineModel.load(row["path"]) if row else None


def score_unlabeled(features: DataFrame, model: PipelineModel | None, columns, label: str = "risk_category") -> DataFrame | None:
    """(customer_id, predicted_risk_category) of the rows without a label; None without a model."""
    if model is None:
        return None
    unlabeled = features.filter(~F.coalesce(is_populated(label), F.lit(False)))
    return model.transform(prepared(unlabeled, columns)).select("customer_id", "predicted_risk_category")


def best_runs(runs: DataFrame) -> DataFrame:
    """(experiment, f1, model): the run with the highest validation F1 per experiment."""
    scores = runs.filter(F.col("metric") == "val_f1_score")
    best = scores.groupBy("experiment").agg(
        F.max(F.struct(F.col("value").alias("f1"), F.col("classifier").alias("model"))).alias("b")
    )
    return best.select("experiment", "b.f1", "b.model")


def compare_experiments(expected: DataFrame, runs: DataFrame) -> DataFrame:
    """(label, f1, model) per expected (label, experiment); null where nothing has run."""
    return expected.join(best_runs(runs), "experiment", "left").select("label", "f1", "model")
