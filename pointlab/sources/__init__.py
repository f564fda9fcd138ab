"""Readers, split tagging, file sampling, sinks and literal tables."""

from pointlab.sources.files import cut_off, sample_files
from pointlab.sources.legend import legend
from pointlab.sources.points import conform, read_features, read_points, read_splits, route_paths, tag_splits
from pointlab.sources.sink import write_points

__all__ = [
    "conform",
    "cut_off",
    "legend",
    "read_features",
    "read_points",
    "read_splits",
    "route_paths",
    "sample_files",
    "tag_splits",
    "write_points",
]
