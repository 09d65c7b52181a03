"""Continuous upserts and deletes: a stream of operations becomes a log, and the log becomes files.

Each micro-batch is written under its own batch number with overwrite, so a batch that is replayed
after a failure replaces itself. Folding merges the batches written so far into a new version of
the table; deleted keys stay in it as marked rows, so late operations still meet the newer one. Compaction removes what was folded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecframe.operators.bucketed import BucketedTable
from vecframe.operators.tables import log_net_count
from vecframe.sources import storage


class StreamedTable:
    """A ``BucketedTable`` with an operation log: columns ``key``, ``seq``, ``op`` and any others."""

    def __init__(
        self, spark: SparkSession, path: str, *, key: str = "key", seq: str = "seq", op: str = "op",
        delete: str = "delete", buckets: int | None = None,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.base = BucketedTable(spark, f"{self.path}/base", key=key, buckets=buckets)
        self.names = {"key": key, "seq": seq, "op": op, "delete": delete}

    def append(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")

    def start(self, operations: DataFrame, *, checkpoint: str | None = None, **trigger) -> StreamingQuery:
        """Write a stream of operations to the log; without a trigger, what is there now."""
        writer = operations.writeStream.foreachBatch(self.append)
        writer = writer.option("checkpointLocation", checkpoint or f"{self.path}/checkpoint")
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def batches(self) -> list[int]:
        """Numbers of the batches in the log that were written whole, folded or not."""
        found = [n for n in storage.names(self.spark, f"{self.path}/log") if n.startswith("batch_id=")]
        return sorted(int(n.split("=")[1]) for n in found if storage.exists(self.spark, f"{self.path}/log/{n}/_SUCCESS"))

    def _folded(self) -> int:
        latest = self.base.current()
        return latest["high_water"] if latest and latest["high_water"] is not None else -1

    def log(self, last: int | None = None) -> DataFrame | None:
        """Operations not folded yet, up to batch ``last``; folded batches are not even listed."""
        folded = self._folded()
        new = [b for b in self.batches() if b > folded and (last is None or b <= last)]
        if not new:
            return None
        return self.spark.read.option("basePath", f"{self.path}/log").parquet(*[f"{self.path}/log/batch_id={b}" for b in new])

    def read(self) -> DataFrame:
        """The live rows: base under the log, without deleted keys."""
        op, delete, log = self.names["op"], self.names["delete"], self.log()
        if log is None and not self.base.exists():
            raise FileNotFoundError(f"nothing was written at {self.path}")
        rows = self.base.read() if log is None else self.base.merged(log.drop("batch_id"), seq=self.names["seq"])
        return rows.where(F.col(op).isNull() | (F.col(op) != delete))

    def fold(self) -> int | None:
        """Merge the log into a new version of the base; returns the version, None if nothing is new."""
        folded = self._folded()
        new = [b for b in self.batches() if b > folded]
        if not new:
            return None
        return self.base.write(self.base.merged(self.log(new[-1]).drop("batch_id"), seq=self.names["seq"]), high_water=new[-1])

    def compact(self, keep_versions: int = 1) -> dict[str, int]:
        """Remove folded batches, and all but the last versions of the base; returns how many of each. Readers of what goes must have ended.

        A folded batch that a stream writes again afterwards is not read: its number is not above the last one folded.
        """
        folded = [b for b in self.batches() if b <= self._folded()]
        for batch in folded:
            storage.remove(self.spark, f"{self.path}/log/batch_id={batch}")
        return {"batches": len(folded), "versions": len(self.base.drop_old(keep_versions))}

    def pending(self) -> DataFrame:
        """Net rows held in the log."""
        log = self.log()
        if log is None:
            return self.spark.createDataFrame([(0,)], "vector_count long")
        return log_net_count(log, **self.names)
