"""Tables and views of the raw, staging and mart layers in Spark's catalog.

A layer is a database below the warehouse root, so every session on the same
metastore sees the same relations. A raw table is partitioned by ``load_batch``
and a repeated load replaces its own partition. A mart is a view over the table
of its newest build: a rebuild writes a table of its own and then points the
view to it, so no reader sees a half-written mart and a failed build leaves the
one before in place.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitwall.sources.schemas import CONTRACTS, LINEAGE, PARTITIONS

PREFIX = "f1"
BATCH = "load_batch"
KEEP_VERSIONS = 2
# Loads of a table that are merged into one.
FOLD_LOADS = 16
QUARANTINE_DAYS = 30
# Fixed value: how a NULL partition is listed.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def layer_name(layer: str | None, default: str = "default", prefix: str = PREFIX) -> str:
    """Database name of a layer; the default one if no layer is given."""
    return default if layer is None else f"{prefix}_{layer.strip()}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Warehouse:
    """The relations below ``root``; ``prefix`` tells the databases of several warehouses apart."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = PREFIX):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def database(self, layer: str | None) -> str:
        return layer_name(layer, prefix=self.prefix)

    def path(self, layer: str | None, name: str) -> str:
        return f"{self.root}/{self.database(layer)}/{name}"

    def relation(self, layer: str | None, name: str) -> str:
        """Its name in SQL."""
        return f"`{self.database(layer)}`.`{name}`"

    def has(self, layer: str | None, name: str) -> bool:
        return self.spark.catalog.tableExists(self.relation(layer, name))

    def _database(self, layer: str | None) -> str:
        name = self.database(layer)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION {_quoted(f'{self.root}/{name}')}")
        return name

    # --- append-only tables ---

    def append(self, layer: str, name: str, df: DataFrame, batch: str, partition_by: Sequence[str] = ()) -> None:
        """Add ``df`` as one load; the same ``batch`` again replaces it.

        Columns that the table lacks are added to it, and those that ``df``
        lacks are NULL. ``partition_by`` applies when the table is made.
        """
        self._insert("OVERWRITE TABLE", layer, name, df, batch, partition_by)

    def _insert(self, how: str, layer: str, name: str, df: DataFrame, batch: str, partition_by: Sequence[str] = ()) -> None:
        spark, relation = df.sparkSession, self.relation(layer, name)
        if not self.has(layer, name):
            self._database(layer)
            empty = df.limit(0).withColumn(BATCH, F.lit(""))
            empty.write.partitionBy(BATCH, *partition_by).format("parquet").saveAsTable(relation)
        known = spark.table(relation).schema
        new = [f for f in df.schema if f.name not in known.names]
        if new:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {relation} ADD COLUMNS ({added})")
            known = spark.table(relation).schema
        parts = [c for c in self.partitions(layer, name) if c != BATCH]
        values = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in known
            if f.name != BATCH
        ]
        spec = ", ".join([f"{BATCH} = {_quoted(batch)}", *(f"`{c}`" for c in parts)])
        # the table lists its partition columns last and in this order
        spark.sql(f"INSERT {how} {relation} PARTITION ({spec}) SELECT * FROM {{rows}}", rows=df.select(*values))

    def partitions(self, layer: str, name: str) -> list[str]:
        """The partition columns of a table, in order."""
        columns = self.spark.catalog.listColumns(self.relation(layer, name))
        return [c.name for c in columns if c.isPartition]

    def appended(self, layer: str, name: str, reads: str | None = None) -> DataFrame:
        """All loads of an append-only table.

        ``reads`` names the columns and leaves to read, for nested rows, of
        which Spark would read all leaves.
        """
        if reads is None:
            return self.spark.table(self.relation(layer, name))
        return self.spark.read.schema(f"{reads}, {BATCH} STRING").parquet(self.path(layer, name))

    def types_of(self, layer: str, name: str) -> StructType | None:
        """The columns of a table without the loader's own, or None if there is no table."""
        if not self.has(layer, name):
            return None
        own = [*StructType.fromDDL(LINEAGE).names, BATCH]
        return StructType([f for f in self.spark.table(self.relation(layer, name)).schema if f.name not in own])

    def _specs(self, layer: str, name: str) -> list[dict[str, str | None]]:
        """The partitions of a table as column: value."""
        if not self.has(layer, name):
            return []
        rows = self.spark.sql(f"SHOW PARTITIONS {self.relation(layer, name)}").collect()
        parts = ([part.split("=", 1) for part in r[0].split("/")] for r in rows)
        return [{c: None if v == _NULL_PARTITION else unquote(v) for c, v in spec} for spec in parts]

    def _drop(self, layer: str, name: str, specs: Sequence[dict[str, str | None]]) -> None:
        shown = (", ".join(f"`{c}` = {'NULL' if v is None else _quoted(v)}" for c, v in spec.items()) for spec in specs)
        dropped = ", ".join(f"PARTITION ({spec})" for spec in shown)
        if dropped:
            self.spark.sql(f"ALTER TABLE {self.relation(layer, name)} DROP IF EXISTS {dropped}")

    def loads(self, layer: str, name: str) -> list[str]:
        """The loads that a table consists of."""
        return sorted({spec[BATCH] for spec in self._specs(layer, name)})

    def drop_loads(self, layer: str, name: str, batches: Sequence[str]) -> None:
        self._drop(layer, name, [spec for spec in self._specs(layer, name) if spec[BATCH] in batches])

    def fold(
        self,
        layer: str,
        name: str,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        least: int = FOLD_LOADS,
        but: str | None = None,
    ) -> int:
        """Merge the loads of an append-only table, where there are at least ``least``; returns how many there were.

        Merged loads of one round are merged again once there are as many, so
        a row is rewritten a few times only and the number of loads grows with
        the logarithm of their count. Rows of one partition come to one task,
        which splits what outgrows the advisory partition size. A merged load
        is there before the others go. The load ``but`` and its parts stay.
        """
        loads = [b for b in self.loads(layer, name) if but is None or b != but and not b.startswith(f"{but}-")]
        levels: dict[int, list[str]] = {}
        for batch in loads:
            found = re.match(r"fold(\d+)-", batch)
            levels.setdefault(int(found[1]) if found else 0, []).append(batch)
        parts = [c for c in self.partitions(layer, name) if c != BATCH] if loads else []
        for level in range(max(levels, default=-1) + 2):
            group = levels.get(level, [])
            if len(group) < least:
                continue
            rows = self.spark.table(self.relation(layer, name)).filter(F.col(BATCH).isin(group)).drop(BATCH)
            rows = rows if merge is None else merge(rows)
            merged = f"fold{level + 1}-{uuid.uuid4().hex}"
            # a load of a new name has nothing to overwrite, and a table cannot be overwritten while it is read
            self._insert("INTO", layer, name, rows.hint("rebalance", *parts), merged)
            self.drop_loads(layer, name, group)
            levels.setdefault(level + 1, []).append(merged)
        return len(loads)

    def source(self, source: str, table: str, reads: str | None = None) -> DataFrame:
        """A raw table that the models read; ``reads`` narrows a nested one."""
        if (source, table) not in CONTRACTS:
            raise KeyError(f"unknown source table {source}_{table}")
        return self.appended("raw", f"{source}_{table}", reads).drop(BATCH)

    def partition_of(self, source: str, endpoint: str) -> tuple[str, ...]:
        return PARTITIONS.get((source, endpoint), ())

    # --- marts and views ---

    def replace(
        self, layer: str, name: str, df: DataFrame, cluster_by: Sequence[str] = (), observe: dict[str, Column] | None = None
    ) -> tuple[DataFrame, dict]:
        """Write the next version, point the view to it, and return it with what was observed on the way.

        ``cluster_by`` sorts the table by range, so that a filter on its first
        columns skips row groups. Several columns keep a large key splittable.
        """
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (observe or {}).items()])
        self._database(layer)
        now = dt.datetime.now(dt.timezone.utc)
        version = f"{name}__{now:%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
        df.write.format("parquet").saveAsTable(self.relation(layer, version))
        return self.view(layer, name, f"SELECT * FROM {self.relation(layer, version)}"), seen.get

    def view(self, layer: str, name: str, text: str) -> DataFrame:
        """Make or replace a permanent view."""
        self._database(layer)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.relation(layer, name)} AS {text}")
        return self.spark.table(self.relation(layer, name))

    def table(self, layer: str, name: str) -> DataFrame:
        if not self.has(layer, name):
            raise LookupError(f"there is no {self.database(layer)}.{name}")
        return self.spark.table(self.relation(layer, name))

    def versions(self, layer: str, name: str) -> list[str]:
        """The tables that builds of a mart have written, the oldest first."""
        tables = self.spark.catalog.listTables(self.database(layer), f"{name}__*")
        return sorted(t.name for t in tables if re.fullmatch(rf"{re.escape(name)}__\d{{20}}_[0-9a-f]{{8}}", t.name))

    def drop_old_versions(self, layer: str, name: str, keep: int = KEEP_VERSIONS) -> int:
        """Drop what is older than the ``keep`` newest versions, but never the one in use."""
        versions = self.versions(layer, name)
        text = self.spark.sql(f"SHOW CREATE TABLE {self.relation(layer, name)}").first()[0]
        old = [v for v in versions[: max(0, len(versions) - keep)] if v not in text]
        for version in old:
            self.spark.sql(f"DROP TABLE {self.relation(layer, version)}")
        return len(old)

    # --- quarantine retention ---

    def purge_quarantine(self, as_of: dt.date, days: int = QUARANTINE_DAYS) -> int:
        """Drop the days that fell out of retention; returns their number."""
        limit = (as_of - dt.timedelta(days=days)).isoformat()
        old = [spec for spec in self._specs("raw", "raw_quarantine") if spec["quarantined_on"] < limit]
        self._drop("raw", "raw_quarantine", old)
        return len({spec["quarantined_on"] for spec in old})


def expire_quarantine(df: DataFrame, as_of, days: int = QUARANTINE_DAYS) -> DataFrame:
    """Quarantined rows still inside retention."""
    as_of = F.lit(as_of).cast("timestamp")
    return df.filter(F.col("quarantined_at") >= as_of - F.make_dt_interval(F.lit(days)))
