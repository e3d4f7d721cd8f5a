"""Layered tables with comments, tags, lineage and per-role views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from copy import copy
from threading import Lock
from typing import Literal

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ledgerlens.contract import LAYERS, LINEAGE_SCHEMA, QUALITY_SCHEMA, ROLE_LAYERS, ROLE_WRITES
from ledgerlens.operators.joins import assert_unique_key


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


MANIFEST_SCHEMA = (
    "layer STRING, table STRING, columns STRING, partitions ARRAY<STRING>, comment STRING, "
    "tags MAP<STRING,STRING>, created_at TIMESTAMP"
)


def _named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


_SETTING = Lock()


def _replace_partitions(df: DataFrame, target: str) -> None:
    """Overwrites the partitions of ``target`` that ``df`` has rows for.

    Inserting into a table takes the mode from the session alone, so it is set for as long as the write lasts.
    """
    mode, session = "spark.sql.sources.partitionOverwriteMode", df.sparkSession
    with _SETTING:
        before = session.conf.get(mode)
        session.conf.set(mode, "dynamic")
        try:
            df.write.insertInto(target, overwrite=True)
        finally:
            session.conf.set(mode, before)


class TableStore:
    """Tables below ``root``, one database per layer, named ``<name>_<layer>``.

    A manifest below ``root`` keeps what a catalog in memory would lose with its
    session: columns, partitioning, comment and tags of every table. Opening a store
    registers the tables the catalog does not know.
    """

    def __init__(self, spark: SparkSession, root: str, name: str = "lake", role: str | None = None):
        self.spark, self.root, self.name, self.role = spark, root.rstrip("/"), name, role
        for layer in LAYERS:
            spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                f"LOCATION {_quoted(f'{self.root}/{layer}')}"
            )
        self._register_stored()

    def for_role(self, role: str) -> TableStore:
        """The same tables with the rights of a role: other reads and writes raise PermissionError.

        This keeps jobs to their layers; files stay readable to whoever can reach them.
        """
        if role not in ROLE_LAYERS:
            raise ValueError(f"unknown role {role!r}")
        limited = copy(self)
        limited.role = role
        return limited

    def _require(self, rights: Mapping[str, Sequence[str]], verb: str, layer: str) -> None:
        if self.role is not None and layer not in rights[self.role]:
            raise PermissionError(f"{self.role} may not {verb} layer {layer!r}")

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.name}_{layer}"

    def full_name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        comment: str = "",
        tags: Mapping[str, str] | None = None,
        sources: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        replace: Literal["all", "partitions"] = "all",
        unique_key: str | None = None,
        rebalance: bool = True,
    ) -> DataFrame:
        """Replaces a table by ``df`` and returns the stored table.

        The layer is recorded as property ``quality``; ``sources`` (full names)
        become lineage edges. ``replace="partitions"`` keeps a table that is there
        and replaces only the partitions that ``df`` has rows for, so repeating a
        write changes nothing. ``unique_key`` is checked on the stored table, once per
        write instead of once per lookup in it. ``rebalance=False`` spares the shuffle by
        partition where ``df`` lies in tasks of good size with few partitions in each.
        """
        self._require(ROLE_WRITES, "write", layer)
        target = self.full_name(layer, table)
        if partition_by and rebalance:
            # Otherwise every task writes a file into every partition; AQE splits oversized ones.
            df = df.hint("rebalance", *partition_by)
        if replace == "partitions" and self.spark.catalog.tableExists(target):
            if not partition_by:
                raise ValueError("only a partitioned table is replaced in parts")
            _replace_partitions(df.select(*self.read(layer, table).columns), target)
            self.spark.catalog.refreshTable(target)
            return self.read(layer, table)
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option("path", f"{self.root}/{layer}/{table}").saveAsTable(target)
        if comment:
            self.spark.sql(f"COMMENT ON TABLE {target} IS {_quoted(comment)}")
        known = {"quality": layer, **(tags or {})}
        self._set_properties(target, known)
        self._note(layer, table, partition_by, comment, known)
        if sources:
            self._append_lineage(sources, target)
        stored = self.spark.table(target)
        return stored if unique_key is None else assert_unique_key(stored, unique_key)

    def read(self, layer: str, table: str) -> DataFrame:
        self._require(ROLE_LAYERS, "read", layer)
        return self.spark.table(self.full_name(layer, table))

    def tables(self, layer: str) -> list[str]:
        return [t.name for t in self.spark.catalog.listTables(self.database(layer)) if not t.isTemporary]

    # --- tags ---

    def tag(self, layer: str, table: str, tags: Mapping[str, str]) -> None:
        self._set_properties(self.full_name(layer, table), tags)
        noted = self._latest_notes().filter((F.col("layer") == layer) & (F.col("table") == table)).first()
        if noted:
            self._note(layer, table, noted.partitions, noted.comment, {**noted.tags, **tags})

    def _set_properties(self, target: str, tags: Mapping[str, str]) -> None:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in tags.items())
        self.spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({pairs})")

    def tags(self, layer: str, table: str) -> DataFrame:
        """Properties of a table as rows ``(key, value)``."""
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(layer, table)}")

    # --- manifest ---

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/_manifest"

    def _note(self, layer: str, table: str, partitions: Sequence[str], comment: str, tags: Mapping[str, str]) -> None:
        columns = ", ".join(f"{_named(f.name)} {f.dataType.simpleString()}" for f in self.read(layer, table).schema)
        row = (layer, table, columns, list(partitions), comment, dict(tags), None)
        self._append(self.spark.createDataFrame([row], MANIFEST_SCHEMA), self.manifest_path)

    def _latest_notes(self) -> DataFrame:
        newest = F.max_by(F.struct("columns", "partitions", "comment", "tags"), "created_at")
        return self._log(self.manifest_path, MANIFEST_SCHEMA).groupBy("layer", "table").agg(newest.alias("_n")).select(
            "layer", "table", "_n.*"
        )

    def _register_stored(self) -> None:
        """Registers stored tables; the loop is over one row per table, not over data."""
        for noted in self._latest_notes().collect():
            target = self.full_name(noted.layer, noted.table)
            if self.spark.catalog.tableExists(target):
                continue
            layout = f"PARTITIONED BY ({', '.join(map(_named, noted.partitions))}) " if noted.partitions else ""
            about = f"COMMENT {_quoted(noted.comment)} " if noted.comment else ""
            self.spark.sql(
                f"CREATE TABLE {target} ({noted.columns}) USING parquet {layout}{about}"
                f"LOCATION {_quoted(f'{self.root}/{noted.layer}/{noted.table}')}"
            )
            if noted.partitions:
                self.spark.catalog.recoverPartitions(target)
            self._set_properties(target, noted.tags)

    # --- lineage ---

    @property
    def lineage_path(self) -> str:
        return f"{self.root}/_lineage"

    def _append_lineage(self, sources: Sequence[str], target: str) -> None:
        edges = self.spark.createDataFrame(
            [(source, target) for source in sources],
            "source_table_full_name STRING, target_table_full_name STRING",
        )
        self._append(edges, self.lineage_path)

    def lineage(self) -> DataFrame:
        return self._log(self.lineage_path, LINEAGE_SCHEMA)

    # --- rule outcomes ---

    @property
    def quality_path(self) -> str:
        return f"{self.root}/_quality"

    def record_quality(self, layer: str, table: str, metrics: DataFrame) -> None:
        """Keeps the ``rule_metrics`` of the rows a table was built from."""
        named = metrics.select(
            F.lit(self.full_name(layer, table)).alias("table_full_name"), "rule", "action", "evaluated", "passed", "failed"
        )
        self._append(named, self.quality_path)

    def quality(self) -> DataFrame:
        return self._log(self.quality_path, QUALITY_SCHEMA)

    # --- stream batches ---

    @property
    def batches_path(self) -> str:
        return f"{self.root}/_batches"

    def finish_batch(self, number: int) -> None:
        """Notes that all tables hold a micro-batch; noting it again changes nothing."""
        self._append(self.spark.createDataFrame([(number,)], "batch INT"), self.batches_path)

    def finished_batch(self) -> int:
        """The last finished micro-batch, -1 before the first."""
        last = self._log(self.batches_path, "batch INT, created_at TIMESTAMP").agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def _append(self, rows: DataFrame, path: str) -> None:
        rows.withColumn("created_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)

    def _log(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException:  # nothing written yet
            return self.spark.createDataFrame([], schema)

    # --- roles ---

    def role_views(self, role: str, columns: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
        """Tables a role may read, by ``layer.table``; also temporary views ``<role>_<layer>_<table>``.

        ``columns`` narrows a table to the named columns. This organises access;
        it is no security boundary, as files stay readable to whoever can reach them.
        """
        views = {}
        for layer in ROLE_LAYERS[role]:
            for table in self.tables(layer):
                view = self.read(layer, table)
                if columns and table in columns:
                    view = view.select(*columns[table])
                view.createOrReplaceTempView(f"{role.replace('-', '_')}_{layer}_{table}")
                views[f"{layer}.{table}"] = view
        return views
