"""The analyses: each takes a table and returns a table."""

from lexloom.plans.classification import Classified, classify
from lexloom.plans.clusters import ClusterProfile, cluster_profile
from lexloom.plans.collecting import collect_by, collect_chunks, token_bag
from lexloom.plans.drift import (
    drift_by_entity,
    drift_overall,
    joined_vectors,
    period_vectors,
)
from lexloom.plans.keywords import group_keywords
from lexloom.plans.neighbours import most_similar
from lexloom.plans.topics import topics

__all__ = [
    "Classified",
    "ClusterProfile",
    "classify",
    "cluster_profile",
    "collect_by",
    "collect_chunks",
    "drift_by_entity",
    "drift_overall",
    "group_keywords",
    "joined_vectors",
    "most_similar",
    "period_vectors",
    "token_bag",
    "topics",
]
