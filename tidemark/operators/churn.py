"""Churn features, the distributed classifier and batch scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import evaluation

FEATURES = (
    "events_last_30d", "active_users_30d", "open_tickets", "critical_tickets",
    "sla_compliance_rate", "mrr", "is_payment_failed",
)
MIN_TRAINING_ROWS = 10
TRAIN_SHARE = 0.8
SEED = 42


def churn_features(health: DataFrame) -> DataFrame:
    """Model inputs and the proxy label (health tier is Critical); nulls become 0."""
    return health.select(
        "account_id", "events_last_30d", "active_users_30d", "open_tickets", "critical_tickets",
        "sla_compliance_rate", F.col("mrr").cast("double").alias("mrr"),
        F.when(F.col("payment_status") != S.GOOD_STANDING, 1).otherwise(0).alias("is_payment_failed"),
        F.when(F.col("health_tier") == "Critical", 1).otherwise(0).alias("churn_label"),
    ).fillna(0)


def stratified_split(features: DataFrame, label: str = "churn_label", key: str = "account_id") -> DataFrame:
    """Add ``is_train``: about 80 % of each class, by hash order of the key.

    The cut is each class's 80th percentile of the hash, so the split repeats
    exactly and needs neither a sort nor a whole class in one task.
    """
    hashed = features.withColumn("_hash", F.xxhash64(F.col(key), F.lit(SEED)))
    cuts = hashed.groupBy(label).agg(F.percentile_approx("_hash", TRAIN_SHARE, 10_000).alias("_cut"))
    # One row per class of a 0/1 label.
    return hashed.join(F.broadcast(cuts), label).withColumn("is_train", F.col("_hash") <= F.col("_cut")).select(
        *features.columns, "is_train")


def balanced_weights(train: DataFrame, label: str = "churn_label") -> DataFrame:
    """Add ``weight`` = rows / (2 * rows of the class)."""
    classes = train.groupBy(label).agg(F.count(F.lit(1)).alias("_of_class"))
    total = classes.agg(F.sum("_of_class")).scalar()
    weights = classes.select(label, (total / (F.col("_of_class") * 2.0)).alias("weight"))
    return train.join(F.broadcast(weights), label)


def train_churn_model(features: DataFrame, trees: int = 150, depth: int = 6) -> tuple[PipelineModel | None, dict]:
    """Fit the forest on the training part; returns the model and its report.

    Training is skipped, with the reason in the report, for fewer than ten rows
    or a single class.
    """
    features = features.persist()
    try:
        classes = features.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("churn_label").alias("k")).first()
        if classes["n"] < MIN_TRAINING_ROWS:
            return None, {"status": "skipped", "reason": "not enough rows", "rows": classes["n"]}
        if classes["k"] < 2:
            return None, {"status": "skipped", "reason": "only one class", "rows": classes["n"]}
        return _fit(features, classes["n"], trees, depth)
    finally:
        features.unpersist()


def _fit(features: DataFrame, rows: int, trees: int, depth: int) -> tuple[PipelineModel, dict]:
    split = stratified_split(features)
    train = balanced_weights(split.where("is_train")).persist()
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="churn_label", weightCol="weight",
        numTrees=trees, maxDepth=depth, seed=SEED,
    )
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    try:
        model = Pipeline(stages=[assembler, forest]).fit(train)
    finally:
        train.unpersist()
    # The training summary holds the session, which cannot be sent to tasks once metrics were observed in it.
    model.stages[-1]._java_obj.setSummary(features.sparkSession._jvm.scala.Option.empty())
    scored = churn_probability(model, split.where("NOT is_train"), keep=["churn_label"])
    quality = evaluation.classification_metrics(scored, "churn_probability", "churn_label", 0.5).first().asDict()
    auc = evaluation.roc_auc(scored, "churn_probability", "churn_label").first()
    importances = model.stages[-1].featureImportances.toArray()
    report = {"status": "trained", "rows": rows, **quality, "roc_auc": auc["roc_auc"],
              "feature_importances": {f: round(float(v), 4) for f, v in zip(FEATURES, importances)}}
    return model, report


def churn_probability(model: PipelineModel, features: DataFrame, keep: list[str] | None = None) -> DataFrame:
    scored = model.transform(features)
    return scored.select("account_id", *(keep or []),
                         vector_to_array("probability")[1].alias("churn_probability"))


def risk_tier(probability: Column) -> Column:
    return (
        F.when(probability.isNull(), "Unknown").when(probability >= S.MODEL_HIGH_FROM, "High")
        .when(probability >= S.MODEL_MEDIUM_FROM, "Medium").otherwise("Low")
    )


def recommended_action(probability: Column) -> Column:
    return (
        F.when(probability.isNull(), "Train churn model first")
        .when(probability >= S.MODEL_HIGH_FROM, "Schedule Executive Retention Review")
        .when(probability >= S.MODEL_MEDIUM_FROM, "Schedule Customer Success Check-in")
        .otherwise("Continue Monitoring")
    )


def churn_risk_tiers(scored: DataFrame, probability: str = "churn_probability") -> DataFrame:
    """Tier and recommended action; a null probability means no trained model."""
    p = F.col(probability)
    return scored.select(
        "account_id", F.round(p, 3).alias("churn_probability"), risk_tier(p).alias("risk_tier"),
        recommended_action(p).alias("recommended_action"),
    )


def score_accounts(model: PipelineModel | None, health: DataFrame) -> DataFrame:
    """Batch scoring of the health mart; without a model every tier is Unknown."""
    defaults = health.fillna({"sla_compliance_rate": 100.0})
    features = churn_features(defaults)
    if model is None:
        return churn_risk_tiers(features.select("account_id", F.lit(None).cast("double").alias("churn_probability")))
    return churn_risk_tiers(churn_probability(model, features))
