"""Named tables by layer, stored as immutable parquet versions.

Layout::

    <root>/<schema>/<table>/data-<n>-<id>/part-*.parquet  data written by version n
    <root>/<schema>/<table>/_commits/<n>.json         commit record of version n

A version becomes visible only when its commit record exists.  A record is
written under a temporary name and renamed without overwrite, so it is whole
or absent, and every writer commits exactly the version after the one it read:
of two writers on one version the second fails, and no update is lost.  An
uncommitted ``data-<n>`` folder is ignored.  A full rebuild or an upsert writes
a new version next to the one it reads, which avoids the "overwrite the path
you are reading" failure of plain parquet sinks.  An append names its new
folder only; readers collect the folders back to the last whole record, which
every ``WHOLE_EVERY``-th append writes.

The commit record also carries the schema (reads open no footers to find it),
the time partitioning, the high-water mark of the version column and the last
stream batch id applied, which makes a replayed micro-batch a no-op.

Fact tables are upserted by day partition (``upsert``): a batch rewrites only
the partitions it touches and the new commit references every other partition
folder of the previous version, so an incremental run costs O(batch + touched
partitions), not O(table).

The batches of a stream are upserted one after the other and each may touch all
partitions (``upsert_later``): a commit then adds the batch as it is to the rows
still to be merged, readers merge them, and the partitions are rewritten when
these rows have grown to the size of the table.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.dedupe import latest_per_key
from martflow.operators.merge import merge_upsert
from martflow.schemas import Layers

WHOLE_EVERY = 20
CODEC = "zstd"  # of appended and partitioned files; a replaced table may be a dimension, whose file size decides on broadcasts
PART = "_part"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
PENDING_FOLDERS = 50  # most batches that readers merge
BATCH = "_batch"
# what a record says of its own version; the rest is the writer's ``meta``
OWN_FIELDS = {"version", "data", "add", "mode", "schema", "partitions", "touched", "layout", "hwm", "pending"}


class TableStore:
    def __init__(self, spark: SparkSession, root: str, layers: Layers = Layers()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layers = layers
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._jvm = jvm

    # paths ------------------------------------------------------------------
    def table_path(self, layer: str, name: str, schema: str | None = None) -> str:
        return f"{self.root}/{self.layers.resolve(layer, schema)}/{name}"

    def _fs(self, path: str):
        return self._Path(path).getFileSystem(self._conf)

    # commit log ---------------------------------------------------------------
    def _commit_dir(self, layer, name):
        return f"{self.table_path(layer, name)}/_commits"

    def versions(self, layer: str, name: str) -> list[int]:
        d = self._commit_dir(layer, name)
        fs = self._fs(d)
        p = self._Path(d)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            # an empty record is the remains of a torn write, not a version
            if n.endswith(".json") and n[:-5].isdigit() and st.getLen() > 0:
                out.append(int(n[:-5]))
        return sorted(out)

    def newest_version(self, layer: str, name: str) -> int | None:
        """The last of ``versions``, without asking for the length of every record."""
        d = self._commit_dir(layer, name)
        fs = self._fs(d)
        if not fs.exists(self._Path(d)):
            return None
        # all names in one call to the JVM
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(self._Path(d)))
        found = self._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)
        for v in sorted({int(n) for n in re.findall(r"/(\d+)\.json(?=[,}])", found)}, reverse=True):
            if fs.getFileStatus(self._Path(f"{d}/{v:020d}.json")).getLen() > 0:
                return v
        return None

    def snapshot(self, layer: str, name: str) -> tuple[int, dict | None]:
        """The newest version and its record; a writer commits the version after it."""
        v = self.newest_version(layer, name)
        return (-1, None) if v is None else (v, self.commit_info(layer, name, v))

    def commit_info(self, layer: str, name: str, version: int | None = None) -> dict | None:
        v = self.newest_version(layer, name) if version is None else version
        if v is None:
            return None
        path = f"{self._commit_dir(layer, name)}/{v:020d}.json"
        stream = self._fs(path).open(self._Path(path))
        try:
            text = self._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
        finally:
            stream.close()
        return json.loads(text)

    def _commit(self, layer: str, name: str, record: dict) -> None:
        folder = self._commit_dir(layer, name)
        final = self._Path(f"{folder}/{record['version']:020d}.json")
        written = self._Path(f"{folder}/.{record['version']:020d}-{uuid.uuid4().hex[:8]}.tmp")
        fs = self._fs(folder)
        out = fs.create(written, False)
        try:
            out.write(bytearray(json.dumps(record, default=str).encode("utf-8")))
        finally:
            out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        no_overwrite = self.spark.sparkContext._gateway.new_array(
            getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files.rename(fs.makeQualified(written), fs.makeQualified(final), no_overwrite)  # fails if the version exists

    def _new_data_dir(self, layer: str, name: str, v: int) -> str:
        """A folder no earlier attempt used: a write retried after a lost
        executor or driver never collides with its own partial output (which
        stays uncommitted and invisible)."""
        return f"{self.table_path(layer, name)}/data-{v:06d}-{uuid.uuid4().hex[:8]}"

    def ensure(self, layer: str, name: str, schema, load_col: str | None = "ingestion_ts") -> int:
        """Create-if-missing: commit an empty version 0 with ``schema`` (+ the
        load stamp column) so readers of a never-loaded table get zero rows."""
        vs = self.versions(layer, name)
        if vs:
            return vs[-1]
        fields = list(schema.fields)
        if load_col and load_col not in schema.fieldNames():
            fields.append(T.StructField(load_col, T.TimestampNTZType()))
        empty = self.spark.createDataFrame([], T.StructType(fields))
        return self.replace(layer, name, empty)

    # read / write -------------------------------------------------------------
    def exists(self, layer: str, name: str) -> bool:
        return bool(self.versions(layer, name))

    def folders(self, layer: str, name: str, info: dict) -> list[str]:
        """Data folders of a version: its own, and an append's back to the last whole record."""
        added: list[str] = []
        while "data" not in info:
            added = info["add"] + added
            info = self.commit_info(layer, name, info["version"] - 1)
        return info["data"] + added

    def _rows(self, folders: Sequence[str], info: dict) -> DataFrame:
        """Rows of ``folders`` under the version's schema; columns that older files lack are NULL."""
        schema = T.StructType.fromJson(info["schema"])
        return (self.spark.read.schema(schema).parquet(*folders) if folders
                else self.spark.createDataFrame([], schema))

    def read(self, layer: str, name: str, version: int | None = None) -> DataFrame | None:
        """The table's rows (none for an empty version); None if it does not exist."""
        info = self.commit_info(layer, name, version)
        if info is None:
            return None
        stored = self._rows(self.folders(layer, name, info), info)
        if "pending" not in info:
            return stored
        pending = info["pending"]
        return merge_upsert(stored, self._newest(self._pending_rows(info), pending, info["layout"]["column"]), pending["keys"],
                            ts_col=info["layout"]["column"], dedupe=False)

    def read_new(self, layer: str, name: str, since_version: int | None) -> DataFrame | None:
        """Rows of an append-only table added after ``since_version`` (all if None)."""
        info = self.commit_info(layer, name)
        if info is None:
            return None
        seen = (set(self.folders(layer, name, self.commit_info(layer, name, since_version)))
                if since_version is not None else set())
        return self._rows([d for d in self.folders(layer, name, info) if d not in seen], info)

    @staticmethod
    def _schema(df: DataFrame, old: dict | None) -> dict:
        """Schema of a version: the stored columns, then new ones; readers see every column as nullable."""
        known = list(T.StructType.fromJson(old["schema"]).fields) if old else []
        names = {f.name for f in known}
        fields = known + [f for f in df.schema.fields if f.name not in names]
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields]).jsonValue()

    @staticmethod
    def _observed(df: DataFrame, hwm_col: str | None):
        """Attach a max(hwm_col) observation: the mark is computed by the write
        job itself (no second pass over the data)."""
        if not hwm_col:
            return df, None
        obs = Observation()
        return df.observe(obs, F.max(hwm_col).alias("hwm"), F.count(F.lit(1)).alias("rows")), obs

    @staticmethod
    def _mark_text(obs) -> str | None:
        if obs is None:
            return None
        try:
            m = obs.get.get("hwm")
        except Py4JJavaError:  # a plan known to be empty runs no observation
            return None
        return None if m is None else m.isoformat(sep=" ")

    @staticmethod
    def _observed_rows(obs) -> int:
        try:
            return obs.get["rows"]
        except Py4JJavaError:  # as above
            return 0

    def _write_version(self, df: DataFrame, path: str, cluster_by: Sequence[str] | None, codec: str | None = None) -> None:
        if cluster_by:
            # Range-partition and sort on the clustering columns: files and row
            # groups then cover narrow min/max ranges, so later filters on
            # these columns skip most of them.
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        writer = df.write.mode("errorifexists")
        (writer.option("compression", codec) if codec else writer).parquet(path)

    def replace(self, layer: str, name: str, df: DataFrame, cluster_by: Sequence[str] | None = None,
                hwm_col: str | None = None, meta: dict | None = None) -> int:
        """Full rebuild: the new version holds exactly ``df``."""
        base, _ = self.snapshot(layer, name)
        path = self._new_data_dir(layer, name, base + 1)
        df, obs = self._observed(df, hwm_col)
        self._write_version(df, path, cluster_by)
        record = {"version": base + 1, "data": [path], "mode": "replace", "schema": self._schema(df, None)}
        if hwm_col:
            record["hwm"] = self._mark_text(obs)
        record.update(meta or {})
        self._commit(layer, name, record)
        return base + 1

    def append(self, layer: str, name: str, df: DataFrame, hwm_col: str | None = None,
               meta: dict | None = None, empty: bool = False) -> int:
        """Append: the new version = previous data folders + one new folder (none if the rows are known to be none)."""
        base, old = self._merged(layer, name)
        df, obs = self._observed(df, hwm_col)
        added = [] if empty else [self._new_data_dir(layer, name, base + 1)]
        for path in added:
            self._write_version(df, path, None, CODEC)
        record = {"version": base + 1, "mode": "append", "schema": self._schema(df, old)}
        if old and (base + 1) % WHOLE_EVERY:
            record["add"] = added
        else:
            record["data"] = (self.folders(layer, name, old) if old else []) + added
        if hwm_col:
            new_mark = None if empty else self._mark_text(obs)
            marks = [m for m in ((old or {}).get("hwm"), new_mark) if m is not None]
            record["hwm"] = max(marks) if marks else None
        record.update(meta or {})
        self._commit(layer, name, record)
        return base + 1

    # partitioned upsert ---------------------------------------------------------
    @staticmethod
    def time_partition(col: str = "created_at", grain: str = "day"):
        """Partition value of a TIMESTAMP_NTZ column at day / month / year grain."""
        d = F.to_date(F.col(col))
        if grain == "day":
            return d.cast("string")
        if grain == "month":
            return F.date_format(d, "yyyy-MM")
        if grain == "year":
            return F.year(d).cast("string")
        raise ValueError(f"unknown partition grain {grain!r}")

    def _write_partitioned(self, df: DataFrame, base: str, part, cluster_by, derived=None) -> dict[str, list[str]]:
        order = [PART] + list(cluster_by or [])
        derived = derived or {}
        # Range partitioning on (partition, clustering columns) samples the
        # data, so one huge day is split over many tasks instead of one.  The
        # partition and the derived columns are computed again behind the
        # exchange, which need not carry them.
        (df.drop(*derived).repartitionByRange(part, *order[1:]).withColumns({**derived, PART: part})
         .select(*df.columns, PART).sortWithinPartitions(*order)
         .write.mode("errorifexists").option("compression", CODEC).partitionBy(PART).parquet(base))
        fs = self._fs(base)
        out: dict[str, list[str]] = {}
        for st in fs.listStatus(self._Path(base)):
            n = st.getPath().getName()
            if st.isDirectory() and n.startswith(PART + "="):
                out[n[len(PART) + 1:]] = [f"{base}/{n}"]
        return out

    def upsert(self, layer: str, name: str, incoming: DataFrame, keys: Sequence[str],
               merge_fn, part_col: str = "created_at", grain: str = "day",
               cluster_by: Sequence[str] | None = None,
               hwm_col: str | None = "created_at", meta: dict | None = None,
               derived: Mapping[str, Column] | None = None) -> int:
        """Copy-on-write upsert that rewrites only the affected time partitions.

        ``grain`` sizes the partitions to the data: a partition should hold many
        row groups (day at terabytes per day, year for a few megabytes).

        Affected = partitions receiving incoming rows plus partitions holding a
        stored row of an incoming key (found with a semi join on the key
        columns only, so the rest of the table is never read in full or
        rewritten; partitions that receive rows are affected anyway and are
        left out of this search).  ``merge_fn(existing_subset_or_None, incoming)`` returns the
        new content of those partitions.  Unaffected partitions are carried
        over by reference in the new commit.  ``derived`` names columns that
        follow from others of their row; the write computes them itself.
        """
        keys = list(keys)
        base, info = self._merged(layer, name)
        part = self.time_partition(part_col, grain)
        layout = {"column": part_col, "grain": grain}
        if info is None or "partitions" not in info:
            existing = self.read(layer, name, base) if info else None
            return self._commit_partitions(layer, name, base, info, merge_fn(existing, incoming), None, part, layout,
                                           cluster_by, hwm_col, incoming, meta, derived)
        self._check_layout(info, layout)

        def stored(parts):
            return self.read_partitions(layer, name, parts, base)
        affected = self._affected(info, incoming, keys, part, stored)
        return self._commit_partitions(layer, name, base, info, merge_fn(stored(affected), incoming), affected, part, layout,
                                       cluster_by, hwm_col, incoming, meta, derived)

    def _affected(self, info: dict, incoming: DataFrame, keys: Sequence[str], part, stored) -> set[str]:
        """Partitions that receive rows of ``incoming`` or hold rows of its keys; ``stored`` reads partitions."""
        affected = self.partition_names(incoming.select(part.alias(PART)))
        others = set(info["partitions"]) - affected
        if affected and others:
            rows = stored(others).select(*keys, info["layout"]["column"])
            affected |= self.partition_names(rows.join(incoming.select(*keys), list(keys), "left_semi").select(part.alias(PART)))
        return affected

    # upsert merged by readers -----------------------------------------------------
    def upsert_later(self, layer: str, name: str, incoming: DataFrame, keys: Sequence[str],
                     part_col: str = "created_at", grain: str = "day", cluster_by: Sequence[str] | None = None,
                     meta: dict | None = None, empty: bool = False) -> int:
        """``upsert`` of one of many batches by the rules of ``merge_upsert``, newest ``part_col`` first.

        Rewriting the partitions for each of n batches that touch all of them costs
        O(n * table).  The batch, which has a key once, is stored as it is instead (not
        even that if it is known to be ``empty``) and its commit adds it to the pending
        rows, which readers merge.  The partitions are rewritten in the commit that brings the pending rows to the size
        of the stored ones, or to ``PENDING_FOLDERS`` batches: a row is rewritten
        O(log(table / batch)) times while a table grows.  A batch of other columns or types than the
        table's is upserted at once.
        """
        keys, layout = list(keys), {"column": part_col, "grain": grain}
        base, info = self.snapshot(layer, name)
        created = info is None or "partitions" not in info
        rows, mark, path = 0, None, self._new_data_dir(layer, name, base + 1)
        if created or not empty:
            df, obs = self._observed(incoming.withColumn(BATCH, F.lit(base + 1)), part_col)
            self._write_version(df, path, None, CODEC)
            rows, mark = self._observed_rows(obs), self._mark_text(obs)
        if created or (rows and info["schema"] != self._schema(incoming, None)):
            return self.upsert(layer, name, self.spark.read.schema(incoming.schema).parquet(path), keys,
                               lambda old, new: merge_upsert(old, new, keys, ts_col=part_col, dedupe=False),
                               part_col, grain, cluster_by, part_col, meta)
        self._check_layout(info, layout)
        record = {k: info[k] for k in ("partitions", "layout", "data", "schema")}
        pending = dict(info.get("pending") or {"folders": [], "rows": 0, "keys": keys, "cluster_by": list(cluster_by or [])})
        if pending["keys"] != keys:
            raise ValueError(f"{name} has pending rows of the keys {pending['keys']}")
        if rows:
            if "stored_rows" not in pending:  # read from the footers
                pending["stored_rows"] = self._rows(info["data"], info).count()
            pending |= {"folders": pending["folders"] + [path], "rows": pending["rows"] + rows}
        marks = [m for m in (info.get("hwm"), mark) if m is not None]
        record |= {"version": base + 1, "mode": "later", "hwm": max(marks) if marks else None}
        if pending["folders"]:
            record["pending"] = pending
        if rows and (pending["rows"] >= pending["stored_rows"] or len(pending["folders"]) >= PENDING_FOLDERS):
            return self._merge_pending(layer, name, base, record, meta)
        self._commit(layer, name, record | (meta or {}))
        return base + 1

    def _merge_pending(self, layer: str, name: str, base: int, info: dict, meta: dict | None) -> int:
        """Commit the version after ``base`` with the pending rows of ``info`` merged into the partitions."""
        pending, layout = info["pending"], info["layout"]
        rows, part = self._pending_rows(info), self.time_partition(layout["column"], layout["grain"])

        def stored(parts):
            return self._rows(self._partition_folders(info, parts), info)
        affected = self._affected(info, rows, pending["keys"], part, stored)
        newest = self._newest(rows, pending, layout["column"])
        merged = merge_upsert(stored(affected), newest, pending["keys"], ts_col=layout["column"], dedupe=False)
        return self._commit_partitions(layer, name, base, info, merged, affected, part, layout, pending["cluster_by"],
                                       layout["column"], newest, meta)

    def _merged(self, layer: str, name: str) -> tuple[int, dict | None]:
        """``snapshot``, after a commit that merges pending rows if there are any."""
        base, info = self.snapshot(layer, name)
        if info is None or "pending" not in info:
            return base, info
        self._merge_pending(layer, name, base, info, {k: v for k, v in info.items() if k not in OWN_FIELDS})
        return self.snapshot(layer, name)

    def merge_pending(self, layer: str, name: str) -> int:
        """Merge what readers would merge otherwise; returns the newest version."""
        return self._merged(layer, name)[0]

    def _pending_rows(self, info: dict) -> DataFrame:
        schema = T.StructType.fromJson(info["schema"]).add(BATCH, T.IntegerType())
        return self.spark.read.schema(schema).parquet(*info["pending"]["folders"])

    @staticmethod
    def _newest(rows: DataFrame, pending: dict, version_col: str) -> DataFrame:
        """What upserting the pending batches in turn leaves of each key: a later batch wins if it is newer."""
        at = F.col(version_col)
        order = [at.desc_nulls_last(), F.when(at.isNull(), -F.col(BATCH)).otherwise(F.col(BATCH))]
        return latest_per_key(rows, pending["keys"], order=order).drop(BATCH)

    @staticmethod
    def partition_names(values: DataFrame) -> set[str]:
        """Distinct time partitions of one column: bounded by the number of partitions."""
        return {NULL_PART if r[0] is None else r[0] for r in values.distinct().collect()}

    @staticmethod
    def _check_layout(info: dict, layout: dict) -> None:
        """A table keeps the time partitioning it was written with; another one would duplicate keys."""
        if info["layout"] != layout:
            raise ValueError(f"table is partitioned by {info['layout']}, not {layout}")

    def read_partitions(self, layer: str, name: str, partitions, version: int | None = None) -> DataFrame | None:
        """Rows of the given time partitions only (their folders are read, nothing else)."""
        info = self.commit_info(layer, name, version)
        if info is None:
            return None
        if "pending" in info:  # rows may have come to a partition, or left it
            part = self.time_partition(info["layout"]["column"], info["layout"]["grain"])
            return self.read(layer, name, info["version"]).where(F.coalesce(part, F.lit(NULL_PART)).isin(sorted(partitions)))
        return self._rows(self._partition_folders(info, partitions), info)

    @staticmethod
    def _partition_folders(info: dict, partitions) -> list[str]:
        old = info.get("partitions", {})
        return [d for p in sorted(partitions) for d in old.get(p, [])]

    def replace_partitions(self, layer: str, name: str, df: DataFrame, partitions, part_col: str,
                           grain: str = "day", cluster_by: Sequence[str] | None = None,
                           meta: dict | None = None) -> int:
        """New content for exactly ``partitions`` (all partitions when None); the
        other partitions of the previous version are kept by reference."""
        base, info = self._merged(layer, name)
        layout = {"column": part_col, "grain": grain}
        if info is None or "partitions" not in info:
            partitions = None
        elif partitions is not None:
            self._check_layout(info, layout)
        return self._commit_partitions(layer, name, base, info, df, None if partitions is None else set(partitions),
                                       self.time_partition(part_col, grain), layout, cluster_by, None, None, meta)

    def _commit_partitions(self, layer, name, base, info, df, affected, part, layout, cluster_by, hwm_col,
                           marks_from, meta, derived=None) -> int:
        """``meta`` may be a function of no arguments, called when the rows are written."""
        v = base + 1
        path = self._new_data_dir(layer, name, v)
        df, obs = self._observed(df, hwm_col if marks_from is not None else None)
        written = self._write_partitioned(df, path, part, cluster_by, derived) if affected != set() else {}
        if affected is None:
            pmap = written
        else:
            pmap = {p: d for p, d in info["partitions"].items() if p not in affected}
            pmap.update(written)
        record = {"version": v, "mode": "partitions", "partitions": pmap, "layout": layout,
                  "touched": sorted(written if affected is None else affected),
                  "data": [d for p in sorted(pmap) for d in pmap[p]],
                  "schema": self._schema(df, None if affected is None else info)}
        if hwm_col and marks_from is not None:
            # max over the written rows = max over the batch: rows of the batch
            # that lost to a stored version are not newer than the old mark
            new_mark = self._mark_text(obs) if affected != set() else None
            marks = [x for x in ((info or {}).get("hwm"), new_mark) if x is not None]
            record["hwm"] = max(marks) if marks else None
        elif info and "hwm" in info:
            record["hwm"] = info["hwm"]
        record.update(meta() if callable(meta) else meta or {})
        self._commit(layer, name, record)
        return v

    def high_water_mark(self, layer: str, name: str):
        info = self.commit_info(layer, name)
        return None if info is None else info.get("hwm")
