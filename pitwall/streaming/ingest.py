"""File-arrival ingestion and de-duplication of replayed rows on streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pitwall.operators.latest import latest_by
from pitwall.sources.audit import TABLE as AUDIT
from pitwall.sources.lake import lines_of, load_lines
from pitwall.sources.warehouse import Warehouse

# How often the feeds run.
EVERY_MINUTE = {"processingTime": "1 minute"}
ONCE = {"availableNow": True}

MAX_FILES = 10_000
# Batches after which the loads of a stream are folded.
FOLD_EVERY = 30


def stream_lake(
    spark: SparkSession,
    lake_root: str,
    warehouse: Warehouse,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int = MAX_FILES,
    after: Callable[[str], None] | None = None,
    archive: str | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Load every new lake file once.

    No file is ever too late: it joins the raw table and counts at the next
    build. A batch repeated after a crash replaces its own earlier output.
    ``after`` gets the name of each batch that is loaded. With ``archive``, a
    folder outside the lake, finished files leave the lake, rejected ones
    included, so that it does not grow. The loads of earlier batches are folded
    by and by, so the number of files stays bounded.
    """
    text = spark.readStream.format("text").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files)
    if archive is not None:
        text = text.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def load(lines: DataFrame, batch_id: int) -> None:
        batch = f"stream-{batch_id}"
        if batch_id % fold_every == fold_every - 1:
            # a repeated batch has its own name, so only the others may lose theirs
            for name in ("openf1_laps", "openf1_stints", AUDIT):
                warehouse.fold("raw", name, but=batch)
        load_lines(lines, warehouse, batch)
        if after is not None:
            after(batch)

    writer = lines_of(text.load(lake_root), lake_root).writeStream.foreachBatch(load)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def dedupe_replays(stream: DataFrame, keys: Sequence[str], ts: str = "date_start", watermark: str | None = None) -> DataFrame:
    """Drop repeated copies of a row from a stream.

    The first copy wins, so this suits identical replays only; for the newest
    copy use newest_copies. State lasts for ``watermark`` of event time; without
    one every key is kept and no row is ever late.
    """
    if watermark is None:
        return stream.dropDuplicates(list(keys))
    timed = stream.withColumn(ts, stream[ts].cast("timestamp")).withWatermark(ts, watermark)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def _newest(order: list[str], schema: str, ttl_ms: int | None) -> StatefulProcessor:
    """The newest row of a key. A nested class travels to the tasks by value."""

    class Newest(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("newest", schema, ttl_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            best, columns = None, None
            for part in rows:
                columns = list(part.columns)
                # newest first, missing values last
                part = part.sort_values(order, ascending=False, na_position="last", kind="stable").head(1)
                best = part if best is None else pd.concat([best, part])
            kept = self.state.get() if self.state.exists() else None
            if kept is not None:
                before = pd.DataFrame([list(kept)], columns=columns).astype(best.dtypes.to_dict())
                best = pd.concat([before, best])
            best = best.sort_values(order, ascending=False, na_position="last", kind="stable").head(1)
            row = tuple(None if pd.isna(v) else v for v in best.astype(object).iloc[0])
            if kept is None or row != tuple(kept):
                self.state.update(row)
                yield best

        def close(self) -> None:
            pass

    return Newest()


def newest_copies(stream: DataFrame, keys: Sequence[str], order: Sequence[str], ttl_ms: int | None = None) -> DataFrame:
    """The newest row per key of a stream, whenever it changes; for sinks in update mode.

    The order is that of latest_by, so a later write of an older copy changes
    nothing and ties end the same way in any order of arrival. The state is one
    row per key, for ``ttl_ms`` after its last change if that is given; Spark looks after such state all the time, so a
    query with it does not end by itself.
    """
    # the state holds whole numbers and texts alone: times as microseconds. Copies of a key collapse before the shuffle
    rest = [c for c in stream.columns if c not in keys and c not in order]
    types = {f.name: f.dataType.simpleString() for f in stream.schema}
    times = [c for c, t in types.items() if t == "timestamp"]
    plain = stream.withColumns({c: F.unix_micros(c) for c in times})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    by, keyed = [*order, *rest], list(keys)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.sort_values(by, ascending=False, na_position="last", kind="stable")
            yield rows.drop_duplicates(keyed)

    plain = plain.mapInPandas(first, plain.schema)
    found = plain.groupBy(*keys).transformWithStateInPandas(
        _newest(by, schema, ttl_ms),
        outputStructType=plain.schema,
        outputMode="Update",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )
    return found.withColumns({c: F.timestamp_micros(c) for c in times})


def upsert_latest(
    batch: DataFrame, batch_id: int, warehouse: Warehouse, table: str, keys: Sequence[str], order: Sequence[str]
) -> None:
    """foreachBatch sink: keep the newest row per key, whatever the arrival order.

    Only the batch's own newest rows are written, under the batch id, so that a
    repeated batch changes nothing and a large session is not rewritten each
    minute. read_latest settles the batches against each other.
    """
    warehouse.append("staging", table, latest_by(batch, keys, order), f"stream-{batch_id}")


def compact_latest(warehouse: Warehouse, table: str, keys: Sequence[str], order: Sequence[str]) -> int:
    """Fold the batches of upsert_latest; returns their number.

    The folded rows are written before the batches go, so a crash in between
    only leaves rows that read_latest settles anyway.
    """
    return warehouse.fold("staging", table, lambda rows: latest_by(rows, keys, order), least=2)


def read_latest(warehouse: Warehouse, table: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key over all batches of upsert_latest."""
    rows = warehouse.appended("staging", table).drop("load_batch")
    return latest_by(rows, keys, order)
