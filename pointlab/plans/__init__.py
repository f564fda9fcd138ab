"""Whole jobs: distribution report, feature table, forest search."""

from pointlab.plans.jobs import (
    ForestRun,
    cross_validation_job,
    distribution_job,
    feature_job,
    find_forest,
    forest_job,
    model_job,
    preview_features,
    raw_distribution_job,
    sampled_features_job,
    search_forest,
)

__all__ = [
    "ForestRun",
    "cross_validation_job",
    "distribution_job",
    "feature_job",
    "find_forest",
    "forest_job",
    "model_job",
    "preview_features",
    "raw_distribution_job",
    "sampled_features_job",
    "search_forest",
]
