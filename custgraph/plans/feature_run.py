"""From graph to predictions: graph features, feature table, split, training, scoring."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph.fastrp import EMBEDDING_SIZE, fastrp
from ..graph.louvain import louvain
from ..graph.projection import project
from ..ml.features import feature_columns, feature_table
from ..ml.metrics import evaluate_predictions
from ..ml.registry import load_champion, register, score_unlabeled
from ..ml.split import create_holdout
from ..ml.train import Settings, TrialSet, train_trials
from ..model import FEATURE_LABELS, FEATURE_TYPES
from ..session import cut_lineage


@dataclass(frozen=True)
class FeatureRun:
    features: DataFrame
    node_count: int
    relationship_count: int
    community_count: int
    modularity: float


def graph_features(
    nodes: DataFrame, edges: DataFrame, customers: DataFrame, customer_node: str, size: int = EMBEDDING_SIZE,
    labels: Iterable[str] = FEATURE_LABELS, types: Iterable[str] | DataFrame = FEATURE_TYPES, with_community: bool = True,
) -> FeatureRun:
    """Feature table of the customers; ``customer_node`` is the column with the node id."""
    graph = project(nodes, edges, labels, types)
    ids = customers.select("customer_id", F.col(customer_node).alias("id"))
    vectors = fastrp(graph, size).select("id", "embedding")
    found = louvain(graph)
    embeddings = ids.join(vectors, "id")
    communities = ids.join(found.communities.select("id", "community_id"), "id") if with_community else None
    table = cut_lineage(feature_table(customers, embeddings, size, communities))
    return FeatureRun(table, graph.nodes.count(), graph.directed.count(), found.community_count, found.modularity)


@dataclass(frozen=True)
class ModelRun:
    trials: TrialSet
    promoted: bool
    predictions: DataFrame | None
    evaluation: DataFrame | None


def train_and_score(
    features: DataFrame, registry: str, model_name: str, kept_per_class: int = 10, pca_components: int | None = 5,
    test_size: float | None = None, settings: Settings = Settings(), exclude: tuple[str, ...] = (),
) -> ModelRun:
    """Hides most labels, trains, promotes when better, and scores what has no label."""
    hidden, truth = create_holdout(features, kept_per_class=kept_per_class, seed=settings.seed)
    hidden, truth = cut_lineage(hidden), cut_lineage(truth)
    trials = train_trials(hidden, exclude=exclude, pca_components=pca_components, test_size=test_size, settings=settings)
    best = trials.best
    spark = features.sparkSession
    promoted = register(spark, registry, model_name, best.model, best.name, best.cv_f1 or 0.0)
    model = load_champion(spark, registry, model_name)
    columns = feature_columns(hidden, exclude)
    predictions = score_unlabeled(hidden, model, columns)
    evaluation = evaluate_predictions(predictions, truth) if predictions is not None else None
    return ModelRun(trials, promoted, predictions, evaluation)
