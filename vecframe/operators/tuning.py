"""A recall target that stays: tuned on a growing sample, kept with the index, applied by searches, tuned again when queries drift."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.operators import knn
from vecframe.operators.ann import check_target_recall
from vecframe.operators.evaluate import recall_per_query
from vecframe.operators.index import Index

FIRST_SAMPLE, MOST_SAMPLE = 64, 4096
#: One-sided, 95 %.
Z = 1.645
#: Queries whose distance from the index has changed by this share, or whose mean has moved by this share of it, are tuned anew.
DRIFT = 0.1
MULTIPLIERS = [1, 2, 4, 8, 16, 32, 64]
CHOICES = "number long, build string, target double, top_k int, method string, setting int, recall double, low double, sample int, seconds double, exact_seconds double, queries long, gap double, mean array<double>"


@dataclass
class Measured:
    setting: int
    sample: int
    recall: float
    low: float
    high: float
    seconds: float


def confidence(recalls: list[float], z: float = Z) -> tuple[float, float, float]:
    """(mean, lower, upper bound) of the recall behind those of a sample of queries.

    The wider of the interval by their spread and Wilson's for so many yes-or-no answers, so that a sample without a miss does not count as certain.
    """
    n = len(recalls)
    mean = sum(recalls) / n
    spread = z * math.sqrt(sum((r - mean) ** 2 for r in recalls) / max(1, n - 1) / n)
    centre, half = (mean + z * z / (2 * n)) / (1 + z * z / n), z * math.sqrt(mean * (1 - mean) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return mean, min(mean - spread, centre - half), max(mean + spread, centre + half)


def tune(
    index: Index, queries: DataFrame, *, target_recall: float, top_k: int = 10, query_id: str = "query_id", query_vector: str = "vector",
    first_sample: int = FIRST_SAMPLE, most_sample: int = MOST_SAMPLE,
) -> tuple[dict, list[Measured]]:
    """The lowest setting (cells probed, or candidates per hit) that reaches the target with confidence, and what was measured.

    Settings rise until one's lower bound reaches the target; where a sample cannot tell, it is doubled. If the largest sample cannot either, or exact search
    was no slower, the choice is exact search.
    """
    check_target_recall(target_recall)
    names = {"query_id": query_id, "query_vector": query_vector, "top_k": top_k}
    by_cells = index.entry["kind"] == "cells"
    settings = sorted({min(1 << i, index.entry["cells"]) for i in range(17)}) if by_cells else list(MULTIPLIERS)
    exact = (lambda q: index.exact(q, **names)) if by_cells else (lambda q: knn.knn_join(index.rows(), q, metric=index.metric, **index.names, **names))
    approximate = lambda q, s: index.search(q, **({"nprobe": s} if by_cells else {"candidate_multiplier": s}), **names)
    available = queries.count()
    size, at, measured, choice = min(first_sample, available), 0, [], None
    while size and at < len(settings) and choice is None:
        sample = queries.orderBy(F.xxhash64(query_id), query_id).limit(size).persist()
        truth, exact_seconds = _timed(exact(sample))
        while at < len(settings):
            hits, seconds = _timed(approximate(sample, settings[at]))
            found = recall_per_query(hits, truth, top_k)
            recalls = [r.recall for r in found.collect()]  # at most ``most_sample``
            hits.unpersist()
            mean, low, high = confidence(recalls) if recalls else (1.0, 1.0, 1.0)
            if size == available:  # every query was asked: nothing is left to chance
                low = high = mean
            measured.append(Measured(settings[at], size, mean, low, high, seconds))
            if low >= target_recall:
                choice = measured[-1]
                break
            if high >= target_recall and size < min(most_sample, available):
                break  # a larger sample may tell
            at += 1
        truth.unpersist()
        sample.unpersist()
        if choice is None:
            size = min(2 * size, most_sample, available)
    facts = {"target": float(target_recall), "top_k": top_k, "build": index.entry["build"]} | index.query_facts(queries, query_vector)
    if choice is None or exact_seconds <= choice.seconds:
        seconds = exact_seconds if measured else 0.0
        return facts | {"method": "exact", "setting": 0, "recall": 1.0, "low": 1.0, "sample": size, "seconds": seconds, "exact_seconds": seconds}, measured
    return facts | {"method": index.entry["kind"], "setting": choice.setting, "recall": choice.recall, "low": choice.low, "sample": choice.sample, "seconds": choice.seconds, "exact_seconds": exact_seconds}, measured


def _timed(df: DataFrame) -> tuple[DataFrame, float]:
    """The rows, held, and the seconds they took."""
    start = time.perf_counter()
    held = df.persist()
    held.count()
    return held, time.perf_counter() - start


def kept_choice(index: Index, path: str, target_recall: float, top_k: int) -> dict | None:
    """The last choice made for this build of the index, target and k."""
    try:
        choices = index.spark.read.schema(CHOICES).json(f"{path.rstrip('/')}/choices")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None
    of_this = choices.where((F.col("build") == index.entry["build"]) & (F.col("target") == target_recall) & (F.col("top_k") == top_k))
    last = of_this.orderBy(F.desc("number")).first()
    return last.asDict() if last else None


def drifted(before: dict, now: dict, drift: float = DRIFT) -> bool:
    """Whether queries lie elsewhere than those of a choice, by more than chance moves the mean of so few."""
    if not now["queries"]:
        return False
    chance = 3 * math.sqrt(1 / now["queries"] + 1 / max(1, before["queries"]))
    moved = math.dist(before["mean"], now["mean"])
    return abs(now["gap"] - before["gap"]) > drift * before["gap"] + 1e-12 or moved > (drift + chance) * before["gap"] + 1e-12


def keep_target(
    index: Index, queries: DataFrame, path: str, *, target_recall: float, top_k: int = 10, drift: float = DRIFT,
    first_sample: int = FIRST_SAMPLE, most_sample: int = MOST_SAMPLE, **options,
) -> DataFrame:
    """Search with the setting kept for the target; tunes, and keeps the choice, if there is none or the queries have drifted."""
    names = {n: options[n] for n in ("query_id", "query_vector") if n in options}
    choice = kept_choice(index, path, target_recall, top_k)
    if choice is not None:
        if drifted(choice, index.query_facts(queries, options.get("query_vector", "vector")), drift):
            choice = {"number": choice["number"], "stale": True}
    if choice is None or choice.get("stale"):
        number = (choice["number"] if choice else 0) + 1
        choice, _ = tune(index, queries, target_recall=target_recall, top_k=top_k, first_sample=first_sample, most_sample=most_sample, **names)
        columns = [c.split()[0] for c in CHOICES.split(", ")]
        row = tuple(({"number": number} | choice)[c] for c in columns)
        index.spark.createDataFrame([row], CHOICES).coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/choices")
    if choice["method"] == "exact":
        if index.entry["kind"] == "cells":
            return index.exact(queries, top_k=top_k, **options)
        return knn.knn_join(index.rows(), queries, metric=index.metric, top_k=top_k, **index.names, **options)
    setting = {"nprobe": choice["setting"]} if choice["method"] == "cells" else {"candidate_multiplier": choice["setting"]}
    return index.search(queries, top_k=top_k, **setting, **options)
