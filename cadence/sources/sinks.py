"""Warehouse tables on Parquet with the write semantics the jobs need.

* :meth:`Warehouse.insert_new`: append rows whose key is not stored yet
  (first per key within the batch);
* :meth:`Warehouse.upsert`: replace stored rows by key (last per key wins);
* :meth:`Warehouse.overwrite_partitions`: replace whole partitions;
* :meth:`Warehouse.exchange`: retract stored rows by key and insert others, at once.

Re-running a window is therefore idempotent. A write puts its files into a folder of
its own (``<table>/_batch=<id>/<partition>``); one entry in the ``_tables`` log, a small
file renamed into place, then makes it the table's: until then readers see the old
state, and a job lost on the way leaves it as it was. The entry holds the schema and,
per partition, the batches that make it up (``""`` is the one partition of an
unpartitioned table). A partition of MAX_BATCHES batches is rewritten as one by the next
insert that touches it, so files do not pile up. Files are never changed, so a lost task
always finds its inputs.

Only the partitions that a read or write can concern are listed: the log names them.
Tables are read with the stored schema: an empty first run leaves an empty table, and a
partition column keeps its type. Keys and partition values compare NULL-safely. The
partition columns of a table must be functions of its key, for inserts and for upserts.
Two writers of one table are noticed: the second one's entry is refused, and it has to be run again.
"""

from __future__ import annotations

import datetime as _dt
import json
import urllib.parse
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.operators.dedup import anti_join_keys, insert_if_absent, replace_by_key
from cadence.operators.joins import broadcast_bounded, dealt
from cadence.operators.keys import semi_join_keys
from cadence.session import materialised

#: Batches of one partition that are left side by side.
MAX_BATCHES = 16
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------------ files

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _names(self, path: str, folders: bool) -> list[str]:
        fs, where = self._fs(path)
        if not fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory() == folders)

    def _partition_dirs(self, path: str, depth: int) -> list[str]:
        if depth == 0:
            return [""]
        return [f"{d}/{rest}".rstrip("/") for d in self._names(path, True) if "=" in d for rest in self._partition_dirs(f"{path}/{d}", depth - 1)]

    # -------------------------------------------------------------------- log

    def _entry(self, name: str) -> dict | None:
        """The table's newest log entry: ``{"version", "schema", "partition_by", "parts"}``."""
        versions = [v for v in self._names(f"{self.root}/_tables/{name}", False) if v.endswith(".json") and not v.startswith((".", "_"))]
        if not versions:
            return None
        fs, where = self._fs(f"{self.root}/_tables/{name}/{versions[-1]}")
        stream = fs.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _log(self, name: str, entry: dict) -> None:
        """A new entry, written aside and renamed, so that readers see all of it or nothing."""
        folder, version = f"{self.root}/_tables/{name}", f"{entry['version']:012d}.json"
        fs, aside = self._fs(f"{folder}/_{uuid.uuid4().hex}")
        out = fs.create(aside)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        _, place = self._fs(f"{folder}/{version}")
        if fs.exists(place) or not fs.rename(aside, place):
            fs.delete(aside, False)
            raise RuntimeError(f"table {name} was changed by another job; run again")

    # ------------------------------------------------------------------- read

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _plain(self, name: str) -> DataFrame | None:
        """A Parquet folder that no job of the warehouse wrote."""
        fs, where = self._fs(self.path(name))
        if not fs.exists(where) or all(f.startswith("_batch=") for f in self._names(self.path(name), True) + self._names(self.path(name), False)):
            return None  # not written yet, or only staged
        return self.spark.read.parquet(self.path(name))

    def _rows(self, name: str, entry: dict, parts: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        paths = [f"{self.path(name)}/_batch={b}/{p}".rstrip("/") for p in parts for b in entry["parts"][p]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*paths).select(*schema.names)

    def read(self, name: str, between: tuple | None = None) -> DataFrame | None:
        """The stored table (empty if only its entry exists), or a plain Parquet folder of that name.

        ``between``: of a table partitioned by one column, only the partitions with a value in
        this closed range are listed and read."""
        entry = self._entry(name)
        if entry is None:
            df = self._plain(name)
            return df
        parts = list(entry["parts"])
        if between is not None and entry["partition_by"]:
            kind = T.StructType.fromJson(entry["schema"])[entry["partition_by"][0]].dataType
            parts = [p for p in parts if _within(p, kind, between)]
        return self._rows(name, entry, parts)

    def table(self, name: str, fallback: DataFrame | None = None, between: tuple | None = None) -> DataFrame:
        df = self.read(name, between)
        if df is None:
            if fallback is None:
                raise KeyError(f"warehouse table {name} does not exist")
            return fallback
        return df

    # ------------------------------------------------------------------ write

    def _stage(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> dict[str, str]:
        """Write ``df`` as a batch: ``{partition: batch}`` for the partitions that got rows."""
        batch = uuid.uuid4().hex
        path = f"{self.path(name)}/_batch={batch}"
        if partition_by:
            # rows of a partition come together first (large ones are split): one task writes few files
            df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path)
            return {p: batch for p in self._partition_dirs(path, len(partition_by))}
        rows = Observation()
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
        return {"": batch} if rows.get["n"] else {}

    def _state(self, name: str, df: DataFrame, partition_by: Sequence[str] | None) -> dict:
        """The newest entry, or that of a new table; a plain folder's rows become its first batch."""
        entry = self._entry(name)
        if entry is not None:
            if list(partition_by or []) != entry["partition_by"]:
                raise ValueError(f"table {name} is partitioned by {entry['partition_by']}")
            return entry
        plain, by = self._plain(name), list(partition_by or [])
        schema = (df if plain is None else plain).schema
        parts = {} if plain is None else {p: [b] for p, b in self._stage(plain, name, by).items()}
        return {"version": -1, "schema": schema.jsonValue(), "partition_by": by, "parts": parts}

    def _commit(self, name: str, entry: dict, added: dict[str, str], replaced: Sequence[str] = ()) -> None:
        """Make the batches of ``added`` part of the table; ``replaced`` partitions keep nothing else."""
        parts = {p: b for p, b in entry["parts"].items() if p not in set(replaced)}
        for p, b in added.items():
            parts[p] = [*parts.get(p, []), b]
        if entry["version"] >= 0 and parts == entry["parts"]:
            return
        self._log(name, entry | {"version": entry["version"] + 1, "parts": parts})

    def _touched(self, entry: dict, batch: DataFrame) -> list[str]:
        """The stored partitions that ``batch`` has rows for (the log holds as many values)."""
        if not entry["partition_by"]:
            return list(entry["parts"])
        by = entry["partition_by"]
        kinds = [T.StructType.fromJson(entry["schema"])[c].dataType for c in by]
        mine = {tuple(r) for r in batch.select(*by).distinct().collect()}
        return [p for p in entry["parts"] if tuple(_value(d, k) for d, k in zip(p.split("/"), kinds)) in mine]

    def insert_new(self, name: str, incoming: DataFrame, key: Sequence[str], order: Sequence = (),
                   partition_by: Sequence[str] | None = None, existing_filter: Column | None = None,
                   within: tuple | None = None) -> None:
        """Append the rows of ``incoming`` whose key is absent.

        Only stored rows that could share a key are compared: those passing
        ``existing_filter`` (e.g. the load window, when the key holds the time) and, for a
        partitioned table, those in the partitions the batch touches. Where the caller knows
        a range of partition values that holds the whole batch (``within``), the batch is
        written once, straight into the table; else it is materialised to see which it touches.
        """
        entry = self._state(name, incoming, partition_by)
        if not entry["parts"]:
            self._commit(name, entry, self._stage(insert_if_absent(None, incoming, key, order), name, entry["partition_by"]))
            return
        incoming = incoming.select(*T.StructType.fromJson(entry["schema"]).names)
        if within is not None or not entry["partition_by"]:
            kind = T.StructType.fromJson(entry["schema"])[entry["partition_by"][0]].dataType if entry["partition_by"] else None
            near = [p for p in entry["parts"] if kind is None or _within(p, kind, within)]
            self._append(name, entry, incoming, key, order, existing_filter, near)
            return
        with materialised(incoming) as batch:
            self._append(name, entry, batch, key, order, existing_filter, self._touched(entry, batch))

    def _append(self, name, entry, batch, key, order, existing_filter, near: list[str]) -> None:
        existing = self._rows(name, entry, near)
        if existing_filter is not None:
            existing = existing.where(existing_filter)
        added = self._stage(insert_if_absent(existing, batch, key, order), name, entry["partition_by"])
        full = [p for p in added if len(entry["parts"].get(p, [])) >= MAX_BATCHES]
        if full:  # one batch in place of many, the new rows among them
            now = entry | {"parts": {p: [*entry["parts"][p], added[p]] for p in full}}
            whole = self._stage(self._rows(name, now, full).hint("rebalance"), name, entry["partition_by"])
            added = {p: b for p, b in added.items() if p not in full} | whole
        self._commit(name, entry, added, full)

    def upsert(self, name: str, incoming: DataFrame, key: Sequence[str], order: Sequence = (),
               partition_by: Sequence[str] | None = None) -> None:
        """Replace by key; rewrites only the partitions present in ``incoming``."""
        entry = self._state(name, incoming, partition_by)
        incoming = incoming.select(*T.StructType.fromJson(entry["schema"]).names)
        if not entry["parts"]:
            self._commit(name, entry, self._stage(replace_by_key(None, incoming, key, order), name, entry["partition_by"]))
            return
        with materialised(incoming) as batch:
            near = self._touched(entry, batch)
            out = replace_by_key(self._rows(name, entry, near), batch, key, order)
            self._commit(name, entry, self._stage(out, name, entry["partition_by"]), near)

    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str], clear: Sequence = ()) -> list[str]:
        """Replace the partitions present in ``df`` (which may read the table), and empty those
        with a value in ``clear`` that have no rows in it. Returns the partitions replaced."""
        entry = self._state(name, df, partition_by)
        added = self._stage(df.select(*T.StructType.fromJson(entry["schema"]).names), name, entry["partition_by"])
        kind = T.StructType.fromJson(entry["schema"])[entry["partition_by"][0]].dataType
        emptied = [p for p in entry["parts"] if p not in added and _value(p.split("/")[0], kind) in set(clear)]
        self._commit(name, entry, added, [*added, *emptied])
        return [*added, *emptied]

    def batches(self, name: str) -> dict | None:
        """``{value: batches}`` of a table partitioned by one column: what a reader that has seen some of it has
        still to read. None if no job of the warehouse wrote the table."""
        entry = self._entry(name)
        if entry is None:
            return None
        kind = T.StructType.fromJson(entry["schema"])[entry["partition_by"][0]].dataType
        return {_value(p, kind): b for p, b in entry["parts"].items()}

    def exchange(self, name: str, incoming: DataFrame, retract: DataFrame, key: Sequence[str], retract_key: Sequence[str],
                 partition_by: Sequence[str], within: tuple | None = None) -> None:
        """Delete the stored rows that ``retract`` names by ``retract_key`` and insert the rows of
        ``incoming`` whose ``key`` is then absent, by one entry of the log. ``retract`` holds the
        columns of ``partition_by`` too. A row that both name ends up stored."""
        with materialised(retract.select(*dict.fromkeys([*retract_key, *partition_by])).distinct()) as gone:
            entry = self._state(name, incoming, partition_by)
            shrink = self._touched(entry, gone)
            if shrink:  # those in which it names a row that is stored
                shrink = self._touched(entry, semi_join_keys(self._rows(name, entry, shrink), dealt(gone), retract_key))
            if not shrink:
                self.insert_new(name, incoming, key, partition_by=partition_by, within=within)
                return
            incoming = incoming.select(*T.StructType.fromJson(entry["schema"]).names)
            with materialised(incoming) as batch:
                kept = anti_join_keys(self._rows(name, entry, shrink), dealt(gone), retract_key)
                grow = [p for p in self._touched(entry, batch) if p not in shrink]
                fresh = insert_if_absent(kept.unionByName(self._rows(name, entry, grow)), batch, key)
                values = broadcast_bounded(self._rows(name, entry, shrink).select(*partition_by).distinct(), known_rows=len(shrink))
                rewritten = self._stage(kept.unionByName(semi_join_keys(fresh, values, partition_by)), name, partition_by)
                elsewhere = self._stage(anti_join_keys(fresh, values, partition_by), name, partition_by)
                self._commit(name, entry, elsewhere | rewritten, shrink)

    def vacuum(self, name: str) -> None:
        """Delete the files and entries that the newest entry has no use for. Not while a job reads or writes the table."""
        entry = self._entry(name)
        if entry is None:
            return
        live = {f"_batch={b}/{p}".rstrip("/") for p, batches in entry["parts"].items() for b in batches}
        depth = len(entry["partition_by"])
        for d in self._names(self.path(name), True):
            for p in self._partition_dirs(f"{self.path(name)}/{d}", depth) if d.startswith("_batch=") else []:
                if f"{d}/{p}".rstrip("/") not in live:
                    fs, where = self._fs(f"{self.path(name)}/{d}/{p}".rstrip("/"))
                    fs.delete(where, True)
        for v in self._names(f"{self.root}/_tables/{name}", False):
            if v.endswith(".json") and not v.startswith((".", "_")) and v != f"{entry['version']:012d}.json":
                fs, where = self._fs(f"{self.root}/_tables/{name}/{v}")
                fs.delete(where, False)


def _value(directory: str, kind: T.DataType):
    """The value in a folder name ``column=value``."""
    text = urllib.parse.unquote(directory.split("=", 1)[1]) if "=" in directory else ""
    if text == _NULL:
        return None
    if isinstance(kind, T.IntegralType):
        return int(text)
    return _dt.date.fromisoformat(text) if isinstance(kind, T.DateType) else text


def _within(partition: str, kind: T.DataType, between: tuple) -> bool:
    value = _value(partition.split("/")[0], kind)
    return value is not None and between[0] <= value <= between[1]
