"""Bronze, Silver and Gold tables in one catalog: named writes and reads."""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Sequence
from datetime import datetime
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.keys import quote
from lakeops.operators.cleaning import stamp
from lakeops.operators.contracts import Contract, enforce
from lakeops.sources.footers import footer_stats

LAYERS = ("bronze", "silver", "gold", "quality")
VERSION = "v-"
CODEC = "zstd"  # of Parquet tables: surrogate keys, hexadecimal digits, take half the bytes that they take with snappy
BLOOM_BYTES = 4 << 20  # about 3.5 million values at one false hit in a hundred
DESCRIPTION = "_lakeops.json"  # beside a version's data; Spark's readers skip names that start so
TRACKED = "spark.sql.hive.manageFilesourcePartitions"
_CREATING = threading.Lock()


class Lake:
    """Tables ``<layer>.<name>`` stored as files under ``root/<layer>/<name>``.

    ``root`` must be a folder every executor can reach (the cluster's shared
    storage; in tests, a folder under ``spark.checkpoint.dir``). Tables are
    registered in the session catalog, so ``spark.table("gold.dim_clients")``
    works, and written data cuts the lineage for later steps.

    A layer's database is ``<namespace>_<layer>``, or ``<layer>`` without a
    namespace. Where another root already has that database, the root's
    checksum is added, so two roots in one catalog stay apart; use the table
    names that ``write`` returns, or ``ref``.

    A replaced Parquet table is written to a version folder of its own before
    the catalog points to it: a failed write leaves the old version readable,
    and so do running readers of it. The catalog entry is changed, never
    dropped, so readers always find the table: one change of its location, and a
    second one of its columns where these differ. (Only other partition columns
    need a new entry.) ``vacuum`` removes versions no longer read.

    Each version keeps its schema and partition columns in a file beside the
    data, so a session whose catalog does not have the table reads it with the
    same types. Partitions are found by listing the version's folder.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", namespace: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.views: dict[str, str] = {}  # table -> temporary view that stands for it
        self.databases = {layer: self._database(f"{namespace}_{layer}" if namespace else layer, layer) for layer in LAYERS}

    def _database(self, name: str, layer: str) -> str:
        place = f"{self.root}/{layer}"
        if self.spark.catalog.databaseExists(name):
            taken = self.spark.catalog.getDatabase(name).locationUri
            if _bare(taken) != _bare(place):
                name = f"{name}_{crc32(self.root.encode()):08x}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{place}'")
        return name

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str) -> str:
        """Catalog name of a table."""
        return f"{self.databases[layer]}.{name}"

    def write(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        cluster_by: str | None = None,
        built_from: str | None = None,
        bloom: Sequence[str] = (),
    ) -> str:
        """Replace (or append to) ``layer.name``; returns the catalog name.

        ``built_from`` says what a version was made of (see `built_from`).

        Partitioned writes are rebalanced on the partition columns first:
        AQE then splits a partition value that holds a large share of the
        rows over several tasks instead of one, and each task writes few files.
        ``cluster_by`` range-partitions and sorts by one column, so each file
        covers a narrow key range and a point lookup skips all but one row
        group by its min/max statistics (for tables unique on that column).
        ``bloom`` lists columns of Parquet tables that get a Bloom filter per
        row group, so a lookup by another column than the one that orders the
        table skips the row groups that cannot hold the value. A filter takes
        as much space as its row group's values need, at most ``BLOOM_BYTES``;
        lookups are exact with filters of any size. (`replace_partitions`
        writes files without them.)
        """
        full = self.table(layer, name)
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        if cluster_by:
            df = df.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
        w = df.write.format(self.fmt)
        if self.fmt == "parquet":
            w = w.option("compression", CODEC)
        if partition_by:
            w = w.partitionBy(*partition_by)
        for column in bloom:
            if self.fmt != "parquet" or column not in df.columns or column in partition_by:
                raise ValueError(f"no Bloom filter for {column}: not a column stored in Parquet files")
            w = w.option(f"parquet.bloom.filter.enabled#{column}", "true")
        if bloom:
            w = w.option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.max.bytes", BLOOM_BYTES)
        if mode == "append" and self.attach(layer, name):
            w.mode("append").saveAsTable(full)
            self._changed(layer, name)
        elif self.fmt == "parquet":
            place = f"{self.path(layer, name)}/{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
            w.save(place)
            self._describe(place, df.schema, partition_by, built_from)
            self._point(full, df.schema, place, partition_by)
        else:  # a table format that replaces atomically itself
            w.mode(mode).option("path", self.path(layer, name)).saveAsTable(full)
        return full

    def replace_partitions(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str]) -> str:
        """Replace the partitions of ``layer.name`` that occur in ``df``; files of all others stay as they are.

        The table is made if it is not there. The current version is changed in place (Spark's dynamic
        partition overwrite: new files are staged and moved when all are written), so a repeated call
        with the same rows gives the same table; a reader may meet a part of the partitions replaced.
        Parquet tables only.
        """
        if self.fmt != "parquet":
            raise ValueError("partitions are replaced in Parquet tables only")
        if not self.attach(layer, name):
            return self.write(df, layer, name, partition_by=partition_by)
        full = self.table(layer, name)
        columns = self.spark.catalog.listColumns(full)
        if [c.name for c in columns if c.isPartition] != list(partition_by):
            raise ValueError(f"{full} is not partitioned by {', '.join(partition_by)}")
        rows = df.select(*(F.col(quote(c.name)).cast(c.dataType).alias(c.name) for c in columns)).hint("rebalance", *partition_by)
        w = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
        w.option("compression", CODEC).parquet(self.location(layer, name))
        self.spark.catalog.refreshTable(full)
        self._changed(layer, name)
        return full

    def drop_partitions(self, layer: str, name: str, column: str, values: Sequence[str]) -> None:
        """Remove the partitions of these values of a table's first partition column."""
        place = self.location(layer, name)
        for value in values:
            escaped = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
            path, fs = self._folder(f"{place}/{column}={escaped}")
            fs.delete(path, True)
        self.spark.catalog.refreshTable(self.table(layer, name))
        self._changed(layer, name)

    def view(self, df: DataFrame, layer: str, name: str) -> str:
        """Let ``layer.name`` be a view of this session: `ref` reads it instead of a table. Returns the view's name."""
        full = self.table(layer, name)
        self.views[full] = f"{self.databases[layer]}__{name}"
        publish_view(df, self.views[full])
        return self.views[full]

    def attach(self, layer: str, name: str) -> bool:
        """Make sure that this session's catalog has a table which has been written; false if there is none."""
        full = self.table(layer, name)
        if not self.spark.catalog.tableExists(full):
            versions = self._versions(layer, name) if self.fmt == "parquet" else []
            known = self._described(versions[-1]) if versions else None
            if known is None:
                return False
            self._point(full, known[0], versions[-1], known[1])
        return True

    def location(self, layer: str, name: str) -> str:
        """The folder of the version that the catalog points to."""
        return self._metadata(self.table(layer, name)).location().toString()

    def _metadata(self, full: str):
        state = self.spark._jsparkSession.sessionState()
        return state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(full))

    def identity(self, layer: str, name: str) -> str | None:
        """Names the content of a Parquet table: its version, and the last change made to that in place. None without a table."""
        if self.fmt != "parquet" or not self.attach(layer, name):
            return None
        place = self.location(layer, name)
        held = self._notes(place)
        return f"{_bare(place)}#{held.get('change', '')}" if held else None

    def built_from(self, layer: str, name: str) -> str | None:
        """What the table's version was made of, as it was given to `write`; None if it was changed since."""
        if self.fmt != "parquet" or not self.attach(layer, name):
            return None
        return self._notes(self.location(layer, name)).get("built_from")

    def _describe(self, place: str, schema: T.StructType, partition_by: Sequence[str], built_from: str | None = None) -> None:
        held = {"schema": schema.jsonValue(), "partition_by": list(partition_by), "built_from": built_from}
        self._note(place, held)

    def _changed(self, layer: str, name: str) -> None:
        """Note that the current version was changed in place."""
        place = self.location(layer, name)
        if held := self._notes(place):
            self._note(place, held | {"built_from": None, "change": uuid.uuid4().hex})

    def _note(self, place: str, held: dict) -> None:
        path, fs = self._folder(f"{place}/{DESCRIPTION}")
        out = fs.create(path, True)
        out.write(json.dumps(held).encode())
        out.close()

    def _notes(self, place: str) -> dict:
        path, fs = self._folder(f"{place}/{DESCRIPTION}")
        if not fs.exists(path):
            return {}
        stream = fs.open(path)
        held = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return held

    def _described(self, place: str) -> tuple[T.StructType, list[str]] | None:
        held = self._notes(place)
        return (T.StructType.fromJson(held["schema"]), held["partition_by"]) if held else None

    def _point(self, full: str, schema: T.StructType, place: str, partition_by: Sequence[str]) -> None:
        """Let the catalog's table read the version at ``place``."""
        if self.spark.catalog.tableExists(full):
            old = self._metadata(full)
            if list(old.partitionColumnNames().mkString("\n").split("\n")) == (list(partition_by) or [""]) and not old.tracksPartitionsInCatalog():
                self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{place}'")
                data = T.StructType([T.StructField(f.name, f.dataType) for f in schema if f.name not in partition_by])
                if T.StructType.fromJson(json.loads(old.dataSchema().json())).simpleString() != data.simpleString():
                    self._set_columns(full, data)
                return
            self.spark.sql(f"DROP TABLE {full}")
        columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema)
        parts = f"PARTITIONED BY ({', '.join(map(quote, partition_by))}) " if partition_by else ""
        with _CREATING:  # partitions are to be listed, not kept in the catalog: that is one change less to be atomic
            before = self.spark.conf.get(TRACKED)
            self.spark.conf.set(TRACKED, "false")
            try:
                self.spark.sql(f"CREATE TABLE {full} ({columns}) USING {self.fmt} {parts}LOCATION '{place}'")
            finally:
                self.spark.conf.set(TRACKED, before)

    def _set_columns(self, full: str, data: T.StructType) -> None:
        """Give the catalog's table other columns, in one change."""
        session = self.spark._jsparkSession.sessionState()
        schema = self.spark._jvm.org.apache.spark.sql.types.DataType.fromJson(data.json())
        database, table = full.split(".")
        session.catalog().externalCatalog().alterTableDataSchema(database, table, schema)
        self.spark.catalog.refreshTable(full)

    def _versions(self, layer: str, name: str) -> list[str]:
        """Completely written versions of a table, oldest first."""
        place = self.path(layer, name)
        folder, fs = self._folder(place)
        if not fs.exists(folder):
            return []
        found = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())
        versions = [f"{place}/{v}" for v in found if v.startswith(VERSION)]
        return [v for v in versions if fs.exists(self._folder(f"{v}/_SUCCESS")[0])]

    def _folder(self, place: str) -> tuple:
        """A folder and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def ref(self, layer: str, name: str) -> DataFrame:
        """Named read of a published table.

        Where this session's catalog does not have it (a new session without a
        shared metastore), it is read from its newest version, with the types
        that were written.
        """
        full = self.table(layer, name)
        if full in self.views:
            return self.spark.table(self.views[full])
        if self.spark.catalog.tableExists(full):
            return self.spark.table(full)
        place = self.path(layer, name)
        folder, fs = self._folder(place)
        if not fs.exists(folder):
            raise FileNotFoundError(f"no table {layer}.{name} under {self.root}")
        # a folder without versions was written by something else
        newest = [place, *self._versions(layer, name)][-1]
        known = self._described(newest)
        reader = self.spark.read.format(self.fmt)
        return (reader.schema(known[0]) if known else reader).load(newest)

    def stats(self, layer: str, name: str, latest: Sequence[str] = ()) -> DataFrame:
        """``row_count`` and the greatest values of the ``latest`` columns of a Parquet table, from its files' footers."""
        if self.fmt != "parquet":
            raise ValueError("footers are read of Parquet tables only")
        if not self.attach(layer, name):
            raise FileNotFoundError(f"no table {layer}.{name} under {self.root}")
        schema = self.spark.table(self.table(layer, name)).schema
        return footer_stats(self.spark, self.location(layer, name), schema, latest)

    def vacuum(self, layer: str, name: str, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions of a Parquet table; returns how many went."""
        if keep < 1:
            raise ValueError("the current version must be kept")
        old = self._versions(layer, name)[:-keep]
        for v in old:
            path, fs = self._folder(v)
            fs.delete(path, True)
        return len(old)


def _bare(uri: str) -> str:
    """A location without its scheme where that is the local file system's."""
    return re.sub(r"^file:/*", "/", uri).rstrip("/")


def write_bronze(
    lake: Lake,
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    load_col: str | None = None,
    run_ts: datetime | None = None,
    built_from: str | None = None,
) -> str:
    """A5/A6: land a raw table, stamping ``load_col`` with ``run_ts`` if it is absent.

    Declared primary keys are not enforced on write (replace semantics); the
    Silver dedup removes re-sent keys.
    """
    if load_col and load_col not in df.columns:
        if run_ts is None:
            raise ValueError("run_ts is needed to stamp a load time")
        df = stamp(df, load_col, run_ts)
    return lake.write(df, "bronze", name, mode=mode, partition_by=partition_by, built_from=built_from)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A10: materialise as a (temporary) view."""
    df.createOrReplaceTempView(name)
    return df


def publish_table(lake: Lake, df: DataFrame, name: str, contract: Contract | None = None, **kw) -> str:
    """A11: contract check before anything is written, then replace ``gold.name``."""
    if contract is not None:
        df = enforce(df, contract)
    return lake.write(df, "gold", name, **kw)


def row_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """``table_name, row_count`` for published tables (one count job per table, unioned)."""
    parts = [spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n.split(".")[-1]).alias("table_name"), "row_count") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
