"""Collections as Parquet folders with published versions.

Plain Parquet has no DELETE or MERGE and cannot be overwritten while it is
read. A mutation therefore writes new files beside the old ones, under a name
of its own, and publishes them last by appending one row to a small version
table. A job that fails leaves the old version current, and its files unseen.

A version says which writes are live and which of the partitions of each have
been replaced. The folder of a write is the outermost one, and a read names the
live ones, so it lists no others. On a partitioned table a mutation rewrites
only the partitions it touches. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanvec.errors import CollectionError
from spanvec.operators import mutations
from spanvec.operators.collections import compact_report
from spanvec.operators.joins import semi_select_ids
from spanvec.operators.rows import assign_ids, number_rows
from spanvec.session import has_folder, materialize

VERSIONS = "version bigint, path string, schema string, live map<string,array<string>>, at timestamp"
# The folder level that tells the writes apart.
WRITE = "_write"
# A mutation that touches more partitions rewrites the whole state.
LISTED_PARTITIONS = 100_000


@dataclass(frozen=True)
class SnapshotTable:
    spark: SparkSession
    root: str
    partition_by: Sequence[str] = ()

    # -- versions ----------------------------------------------------------

    def _current(self) -> Row | None:
        try:
            listed = self.spark.read.schema(VERSIONS).json(f"{self.root}/versions")
        except AnalysisException:
            return None
        newest = F.max_by(F.struct("version", "path", "schema", "live"), "version")
        return listed.agg(newest.alias("m")).first().m

    def _published(self) -> Row:
        current = self._current()
        if current is None:
            raise CollectionError(f"no collection at {self.root}")
        return current

    def version(self) -> int:
        """The published version, 0 before the first one."""
        current = self._current()
        return current.version if current else 0

    def _key(self) -> Column:
        """Name of the partition a row or folder belongs to."""
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in self.partition_by]
        return F.concat_ws("/", *parts) if parts else F.lit("")

    def read(self) -> DataFrame:
        """The published state. Folders of other writes are not listed."""
        return self._state(self._published()).drop(WRITE)

    def _state(self, current: Row) -> DataFrame:
        """The rows of a version with the write that each lies in."""
        if not current.live:
            return self.spark.createDataFrame([], T.StructType([*schema_of(current.schema).fields, T.StructField(WRITE, T.StringType())]))
        # Writes that lost the same partitions share one test.
        alike: dict[tuple[str, ...], list[str]] = {}
        for write, replaced in current.live.items():
            alike.setdefault(tuple(replaced), []).append(write)
        live = F.lit(False)
        for replaced, writes in alike.items():
            held = F.col(WRITE).isin(writes)
            live = live | (held & ~self._key().isin(list(replaced)) if replaced else held)
        return self._files(current, list(current.live)).where(live)

    def _files(self, current: Row, writes: Sequence[str]) -> DataFrame:
        """The rows of some writes; only their folders are listed."""
        fields = schema_of(current.schema).fields
        named = T.StructType([*fields, T.StructField(WRITE, T.StringType())])
        folders = [f"{current.path}/{WRITE}={write}" for write in sorted(writes)]
        rows = self.spark.read.schema(named).option("basePath", current.path).parquet(*folders)
        return rows.select(*[f.name for f in fields], WRITE)

    def _append(self, df: DataFrame, path: str, in_place: bool, per_file: int | None = None) -> str | None:
        """Write rows under a new write name, which nothing refers to yet; without rows there is none."""
        write = uuid.uuid4().hex
        if self.partition_by and not in_place:
            # Spark splits a large partition over tasks and packs small ones.
            df = df.hint("rebalance", *self.partition_by)
        writer = df.withColumn(WRITE, F.lit(write)).write.mode("append")
        if per_file is not None:
            writer = writer.option("maxRecordsPerFile", per_file)
        writer.partitionBy(WRITE, *self.partition_by).parquet(path)
        return write if has_folder(self.spark, f"{path}/{WRITE}={write}") else None

    def _publish(self, version: int, path: str, schema: str, live: Mapping[str, Sequence[str]]) -> int:
        # One row, written last: the switch that makes a version visible.
        row = self.spark.createDataFrame([(version, path, schema, dict(live), None)], VERSIONS)
        stamped = row.withColumn("at", F.current_timestamp())
        stamped.coalesce(1).write.mode("append").json(f"{self.root}/versions")
        return version

    def _start(self, state: DataFrame, version: int) -> int:
        """A version whose rows all lie in a folder of their own."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        write = self._append(state, path, in_place=False)
        return self._publish(version, path, saved_schema(state), {write: []} if write else {})

    def _change(self, added: DataFrame | None, replaced: Mapping[str, Sequence[str]], in_place: bool = False) -> int:
        """Hide the partitions that writes hold and add rows, in one version."""
        old = self._published()
        live = {w: sorted({*gone, *replaced.get(w, ())}) for w, gone in old.live.items()}
        if not self.partition_by and replaced:
            live = {}
        write = None if added is None else self._append(added, old.path, in_place)
        return self._publish(old.version + 1, old.path, old.schema, {**live, write: []} if write else live)

    # -- whole states --------------------------------------------------------

    def create(self, df: DataFrame) -> int:
        """Write the first version; an existing collection is an error."""
        if self._current() is not None:
            raise CollectionError(f"a collection exists at {self.root}")
        return self._start(df, 1)

    def replace(self, state: DataFrame) -> int:
        """Write a whole new state and make it current."""
        return self._start(state, self.version() + 1)

    # -- mutations ---------------------------------------------------------

    def insert(
        self, rows: DataFrame, order_by: str | None = None, per_file: int | None = None
    ) -> int:
        """Append rows and return their number.

        Rows without an id get the ones after the highest in use: in the order
        of a unique numeric column if one is named, else as they come.
        """
        old = self._published()
        state = self.read()
        if order_by is not None or "id" not in rows.columns:
            highest = state.agg(F.max("id").alias("m")).first().m
            if order_by is not None:
                rows = assign_ids(rows, order_by, highest)
            else:
                rows = number_rows(rows, 0 if highest is None else highest + 1)
        write = self._append(rows.select(*state.columns), old.path, False, per_file)
        if write is None:
            return 0
        self._publish(old.version + 1, old.path, old.schema, {**old.live, write: []})
        # Counted from the files: a counter would count a task run again twice.
        return self._files(old, [write]).count()

    def batch_insert(self, rows: DataFrame, batch_size: int) -> int:
        """Append in files of at most ``batch_size`` rows; Spark retries a chunk."""
        return self.insert(rows, per_file=batch_size)

    def _touched(self, rows: DataFrame) -> tuple[int, dict[str, list[str]] | None]:
        """How many rows there are, and the partitions of each write that they lie in.

        None if there are too many to list.
        """
        counts = rows.groupBy(WRITE, self._key().alias("key")).agg(F.count("*").alias("n"))
        found = counts.limit(LISTED_PARTITIONS + 1).collect()
        if len(found) > LISTED_PARTITIONS:
            return rows.count(), None
        held: dict[str, list[str]] = {}
        for r in found:
            held.setdefault(r[WRITE], []).append(r.key)
        return sum(r.n for r in found), held

    def _replaced(self, state: DataFrame, keys: Mapping[str, Sequence[str]]) -> tuple[DataFrame, dict[str, list[str]]]:
        """The rows of the partitions, and which of them each write holds."""
        part = state.where(self._key().isin(sorted({k for ks in keys.values() for k in ks})))
        return part.drop(WRITE), self._touched(part)[1] or {}

    def _rewrite(self, rows: DataFrame, state: DataFrame, work: Callable[[DataFrame], DataFrame], in_place: bool) -> int:
        """Work on the partitions that hold some rows, or on the whole state if these are too many."""
        count, keys = self._touched(rows)
        if keys is None:
            self.replace(work(state.drop(WRITE)))
        elif count:
            part, held = self._replaced(state, keys)
            self._change(work(part), held, in_place)
        return count

    def delete(self, condition: Column | str) -> int:
        state = self._state(self._published())
        return self._rewrite(
            state.where(mutations.matches(condition)), state, lambda part: mutations.delete_where(part, condition), True
        )

    def update(self, condition: Column | str, changes: Mapping[str, Any]) -> int:
        state = self._state(self._published())
        # Built first: an unknown field is found before anything is written.
        mutations.batch_update(state, condition, changes)
        stays = not set(changes) & set(self.partition_by)
        return self._rewrite(
            state.where(mutations.matches(condition)), state, lambda part: mutations.batch_update(part, condition, changes), stays
        )

    def upsert(self, changes: DataFrame, order_by: str | None = None) -> int:
        """Replace and add rows by id, the last change of each; only partitions that hold an id are rewritten."""
        state = self._state(self._published())
        # Used several times; from files Spark also knows how few they are.
        changes = materialize(mutations.last_changes(changes, "id", order_by))
        plain = state.drop(WRITE)
        added = mutations.like(mutations.absent_rows(changes, plain), plain)
        _, keys = self._touched(semi_select_ids(state, changes))
        if keys is None:
            self.replace(mutations.replace_rows(plain, changes).unionByName(added))
        else:
            part, held = self._replaced(state, keys)
            self._change(mutations.replace_rows(part, changes).unionByName(added), held)
        return changes.count()

    def drop_partition(self, names: Sequence[object]) -> int:
        """Drop partitions with their rows; no file is rewritten."""
        if len(self.partition_by) != 1:
            raise CollectionError("the collection is not partitioned by one column")
        state = self._state(self._published())
        gone = state.where(F.col(self.partition_by[0]).isin(list(names)))
        count, keys = self._touched(gone)
        if keys is None:
            self.replace(mutations.delete_where(state, F.col(self.partition_by[0]).isin(list(names))).drop(WRITE))
        elif count:
            self._change(None, keys)
        return count

    def compact(self, deleted: Column | str | None = None, files: int | None = None) -> DataFrame:
        """Rewrite without deleted rows and in fewer files; report both states.

        Without a number of files Spark packs rows to its advisory size.
        """
        before = self.read()
        kept = before if deleted is None else mutations.delete_where(before, deleted)
        if not self.partition_by:
            kept = kept.hint("rebalance") if files is None else kept.repartition(files)
        self.replace(kept)
        return compact_report(before, self.read())


def saved_schema(df: DataFrame) -> str:
    return df.schema.json()


def schema_of(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))
