"""Collections that follow a stream, folded by position.

The state is a Parquet folder of the rows of all collections of one stream, as of
the last batch that was folded into it; a small log holds the folders and their
positions. What was ingested after the position is applied when the state is read,
and becomes part of it when it is folded. A batch is folded once: folding again, a
replayed batch or a restart adds nothing, and a row that was changed or removed
directly stays so, unless a later batch brings it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.session import delete_folder, has_folder
from spanvec.streaming.ingest import ORDER, read_batches, split_operations
from spanvec.streaming.messages import apply_operations, fold_batches, latest_operations

_LOG = "position bigint, change bigint, folder string"


class FoldedStream:
    """The collections under ``root``, where ``stream_ingest`` writes their operations.

    ``schema`` holds ``id``, ``vector`` and the fields that all of them have.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str, id_key: str = "id"):
        self.spark, self.root, self.id_key = spark, root, id_key
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _latest(self) -> tuple[int, int, str | None]:
        """Position, number of direct changes since, and folder of the state."""
        if not has_folder(self.spark, f"{self.root}/log"):
            return -1, 0, None
        log = self.spark.read.schema(_LOG).parquet(f"{self.root}/log")
        last = log.agg(F.max(F.struct("position", "change", "folder")).alias("l")).first().l
        return (-1, 0, None) if last is None else (last.position, last.change, last.folder)

    def _state(self, folder: str | None) -> DataFrame:
        wide = T.StructType([*self.schema.fields, T.StructField("collection", T.StringType())])
        if folder is None:
            return self.spark.createDataFrame([], wide)
        return self.spark.read.schema(wide).parquet(f"{self.root}/state/{folder}")

    def _batches(self, after: int) -> DataFrame:
        return read_batches(self.spark, self.root).where(F.col("batch_id") > after)

    def _applied(self, state: DataFrame, operations: DataFrame) -> DataFrame:
        key = F.struct("collection", "id")
        good, _ = split_operations(state.drop("collection"), operations, self.id_key, ["collection"])
        per_batch = latest_operations(good.withColumn("_key", key), ["_key", "_batch_id"], *[f"_{c}" for c in ORDER[1:]])
        named = state.columns
        folded = fold_batches(per_batch, "_key", "_batch_id", named)
        return apply_operations(state.withColumn("_key", key), folded, "_key", named).drop("_key")

    def read(self, collection: str | None = None) -> DataFrame:
        """The rows now: the state and the operations after it; of all collections, with their name, or of one."""
        position, _, folder = self._latest()
        state, operations = self._state(folder), self._batches(position)
        if collection is None:
            return self._applied(state, operations)
        # The collection is a folder of the state and of each batch.
        of = F.col("collection") == collection
        return self._applied(state.where(of), operations.where(of)).drop("collection")

    def rejects(self) -> DataFrame:
        """Operations after the position that do not fit, with the reason."""
        position, _, folder = self._latest()
        return split_operations(self._state(folder).drop("collection"), self._batches(position), self.id_key, ["collection"])[1]

    def position(self) -> int:
        """The last batch that is part of the state, -1 if none is."""
        return self._latest()[0]

    def _write(self, rows: DataFrame, position: int, change: int) -> None:
        folder = uuid.uuid4().hex
        rows.hint("rebalance", "collection").write.partitionBy("collection").parquet(f"{self.root}/state/{folder}")
        # The folder counts from here on; a job that fails before leaves the state as it was.
        entry = self.spark.createDataFrame([(position, change, folder)], _LOG)
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def fold(self, drop_batches: bool = False) -> int:
        """Make what was ingested part of the state; return the new position.

        With ``drop_batches`` the folders of folded batches and of the state before are deleted.
        """
        position, change, folder = self._latest()
        newest = self._batches(position).agg(F.max("batch_id").alias("b")).first().b
        if newest is None:
            return position
        self._write(self._applied(self._state(folder), self._batches(position).where(F.col("batch_id") <= newest)), newest, 0)
        if drop_batches:
            for batch in range(position + 1, newest + 1):
                delete_folder(self.spark, f"{self.root}/rows/batch_id={batch}")
            if folder is not None:
                delete_folder(self.spark, f"{self.root}/state/{folder}")
        return newest

    def change(self, work: Callable[[DataFrame], DataFrame]) -> None:
        """Fold, then replace the state by what ``work`` makes of it (all collections, with their name)."""
        self.fold()
        position, change, folder = self._latest()
        self._write(work(self._state(folder)), position, change + 1)
