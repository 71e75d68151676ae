"""Operators that also take a streaming DataFrame.

They look at one row at a time (filters, shaping, assignment to given centroids, projection
on a fitted model, network scores), so a stream needs no state, watermark or other code:
apply them between ``readStream`` and ``writeStream`` as they are.
"""

from vectrove.operators.neighbours import assign_clusters
from vectrove.operators.network import score_network
from vectrove.operators.pca import transform_pca
from vectrove.operators.shape import (
    drop_unlabelled,
    labelled_only,
    mask_features,
    scale_max_abs,
    scale_min_max,
    select_class,
    shape_features,
    weight_features,
)
from vectrove.sources.logs import log_metrics_long, parse_training_log

__all__ = [
    "assign_clusters",
    "drop_unlabelled",
    "labelled_only",
    "log_metrics_long",
    "mask_features",
    "parse_training_log",
    "scale_max_abs",
    "scale_min_max",
    "score_network",
    "select_class",
    "shape_features",
    "transform_pca",
    "weight_features",
]
