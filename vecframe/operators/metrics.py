"""Similarity metrics: their names, and the decisions about scores.

The scores themselves are in ``topk`` and ``vectors``. Decisions:

* cosine is the raw value in [-1, 1]; a zero vector scores 0.0 against everything;
* euclidean is a distance, so smaller ranks first, and it is bounded by ``max_distance``;
* scores are computed in DOUBLE from FLOAT vectors;
* equal scores rank by key, ascending; a score that is not a number never ranks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metric names and the aliases used for them by benchmark suites.
METRIC_ALIASES = {
    "cosine": "cosine",
    "COSINE": "cosine",
    "dot_product": "dot_product",
    "IP": "dot_product",
    "euclidean": "euclidean",
    "L2": "euclidean",
}

NORM_FLOOR = 1e-9


def metric_name(metric: str) -> str:
    if metric not in METRIC_ALIASES:
        raise ValueError(f"metric {metric!r} is not one of {sorted(METRIC_ALIASES)}")
    return METRIC_ALIASES[metric]


def metric_column(metric: Column) -> Column:
    """Resolve aliases held in a column; an unknown name fails the job."""
    known = F.create_map(*[F.lit(x) for pair in METRIC_ALIASES.items() for x in pair])
    resolved = F.try_element_at(known, metric)
    return F.coalesce(
        resolved,
        F.raise_error(F.concat(F.lit("unknown metric: "), F.coalesce(metric, F.lit("NULL")))).cast("string"),
    )
