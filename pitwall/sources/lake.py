"""Landing NDJSON in the lake and loading lake files into raw tables.

A file is the unit of acceptance: one bad line rejects the whole file, whose
lines then go to the ``raw_quarantine`` table with the reason.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence
from functools import reduce
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions.columns import fetch_stamp, ingest_ts, lake_path_parts, utc_text
from pitwall.functions.labels import QUARANTINE_PREFIX
from pitwall.session import materialise, scratch_scope
from pitwall.sources.audit import KEY_DAY, audit_log, key_day, write_audit, write_events
from pitwall.sources.schemas import has_bad_node, schema_for, sql_type, typed_node
from pitwall.sources.selection import gate, sanitize, select_sessions
from pitwall.sources.warehouse import BATCH, Warehouse

SERVICE, LANDING = "loader", "landing"
# Events after which a file is not loaded again.
FINISHED = ("loaded", "quarantined", "skipped")
FILES_PER_LOAD = 10_000
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/*"

# --- landing --------------------------------------------------------------------------------


def _land(rows: DataFrame, parts: Sequence[str], root: str, source: str, endpoint: str, warehouse: Warehouse | None, **options) -> None:
    """Append NDJSON files by ``parts``; with a warehouse the rows written are put in the audit log."""
    seen = Observation()
    keyed = rows.withColumns({"source": F.lit(source), "endpoint": F.lit(endpoint)}).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = keyed.write.mode("append").partitionBy("source", "endpoint", *parts).options(**options)
    writer.json(f"{root}/raw")
    if warehouse is not None:
        landed = {"event": "landed", "severity": "INFO", "source": source, "endpoint": endpoint, "output_rows": seen.get["rows"]}
        write_events(warehouse, LANDING, [landed])


def land_pages(
    pages: DataFrame,
    root: str,
    source: str,
    endpoint: str,
    fetched_at: Column,
    pages_per_file: int = 1,
    season: Column | int | None = None,
    warehouse: Warehouse | None = None,
) -> None:
    """Append one NDJSON file per page below raw/source=/endpoint=/dt=/season=/page=/fetch=.

    ``page`` is the offset of the page in its walk, 0 where pages have none;
    without a season the walk is that of all seasons.
    """
    offset = F.col("offset").cast("string").try_cast("bigint") if "offset" in pages.columns else F.lit(None)
    keyed = pages.select(
        "*",
        F.substr(utc_text(fetched_at), F.lit(1), F.lit(10)).alias("dt"),
        F.coalesce(F.lit(season) if not isinstance(season, Column) else season, F.lit("all")).cast("string").alias("season"),
        F.coalesce(offset, F.lit(0)).alias("page"),
        fetch_stamp(fetched_at).alias("fetch"),
    )
    parts = ("dt", "season", "page", "fetch")
    _land(keyed, parts, root, source, endpoint, warehouse, maxRecordsPerFile=pages_per_file)


def landed_pages(spark: SparkSession, root: str, source: str) -> DataFrame:
    """What page_audit needs to know of the landed pages of a source: their walk, total and offset.

    A table, as an audit reads them several times and each page is a file.
    """
    lines = route(read_lines(spark, f"{root}/raw/source={source}", root))
    part = lambda name: F.nullif(F.regexp_extract("object_key", f"/{name}=([^/]+)/", 1), F.lit(""))
    pages = lines.select(
        "source",
        "endpoint",
        part("season").try_cast("bigint").alias("season"),
        F.try_variant_get(F.try_parse_json("value"), "$.total", "string").alias("total"),
        part("page").try_cast("bigint").alias("offset"),
    )
    return materialise(pages, "landed_pages")


def land_rows(
    rows: DataFrame, root: str, source: str, endpoint: str, fetched_at: Column, warehouse: Warehouse | None = None
) -> None:
    """Append one NDJSON file per (session, poll); no rows, no file.

    The rebalance keeps a session in one file and splits it only where it
    outgrows the advisory partition size.
    """
    keyed = sanitize(rows, endpoint).select(
        "*", F.col("session_key").alias("session"), fetch_stamp(fetched_at).alias("fetch")
    )
    _land(keyed.hint("rebalance", "session", "fetch"), ("session", "fetch"), root, source, endpoint, warehouse)


def land_poll(
    feeds: dict[str, DataFrame],
    sessions: DataFrame,
    root: str,
    as_of: dt.datetime,
    session_keys: Sequence[int] | None = None,
    warehouse: Warehouse | None = None,
) -> dict | None:
    """One poll of the timing feed: land the rows of all active sessions.

    ``feeds`` holds the rows per endpoint. Without an active session nothing is
    done and None comes back. ``session_keys`` names the sessions of a backfill,
    active or not.
    """
    now = F.lit(as_of).cast("timestamp")
    if session_keys:
        wanted = {name: select_sessions(rows, session_keys) for name, rows in feeds.items()}
    else:
        active = gate(sessions, now)
        if active is None:
            return None
        keys = active.select("session_key").distinct()
        wanted = {name: rows.join(keys, "session_key", "left_semi") for name, rows in feeds.items()}
    for name, rows in wanted.items():
        land_rows(rows, root, "openf1", name, now, warehouse)
    return landing_summary(sessions.sparkSession, root, as_of)


def landing_summary(spark: SparkSession, root: str, fetched_at: dt.datetime) -> dict:
    """Endpoints, sessions, files and rows that one fetch has landed; a time without a zone is local, as in a literal."""
    utc = fetched_at.astimezone(dt.timezone.utc)
    stamp = f"fetch={utc:%Y%m%dT%H%M%SZ}"
    lines = None
    # rows lie below their session, pages below their day, season and offset
    for parts in ("*", "*/*/*"):
        try:
            found = read_lines(spark, f"{root}/raw/source=*/endpoint=*/{parts}/{stamp}", root)
        except AnalysisException:  # no such directory
            continue
        lines = found if lines is None else lines.unionByName(found)
    if lines is None:
        return {"endpoints": [], "sessions": 0, "files_written": 0, "rows_written": 0}
    files = route(lines).groupBy("endpoint", "object_key").agg(F.count(F.lit(1)).alias("rows"))
    session = F.nullif(F.regexp_extract("object_key", "/session=([^/]+)/", 1), F.lit(""))
    row = files.agg(
        F.sort_array(F.collect_set("endpoint")).alias("endpoints"),
        F.countDistinct(session).alias("sessions"),
        F.count(F.lit(1)).alias("files_written"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_written"),
    ).first()
    return row.asDict()


# --- routing --------------------------------------------------------------------------------


def object_key(path: Column, lake_root: str) -> Column:
    """A file's key relative to the lake root."""
    root = re.sub(_SCHEME, "/", lake_root).rstrip("/") + "/"
    plain = F.regexp_replace(path, _SCHEME, "/")
    return F.when(plain.startswith(root), F.substr(plain, F.lit(len(root) + 1))).otherwise(plain)


def route(df: DataFrame, key: str = "object_key") -> DataFrame:
    """Add source, endpoint, target_table and, for objects not to load, skip_reason."""
    return df.withColumns(lake_path_parts(F.col(key)))


def read_lines(spark: SparkSession, paths: str | Sequence[str], lake_root: str) -> DataFrame:
    """Non-blank lines of lake files with the key of their file."""
    reader = spark.read.option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    return lines_of(reader.text(paths if isinstance(paths, str) else list(paths)), lake_root)


def lines_of(text: DataFrame, lake_root: str) -> DataFrame:
    path = F.col("_metadata.file_path")
    return text.select(
        "value",
        object_key(path, lake_root).alias("object_key"),
        path.alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    ).filter(F.trim("value") != "")


# --- parsing and quarantine -----------------------------------------------------------------


def parse(lines: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Add ``record`` under the types of ``schema`` and ``reason`` (NULL for a good line).

    A line is parsed once, to a VARIANT. Leaves go by their text because
    numbers may be quoted. A value that does not fit its type, an object or a
    list in place of a value, and the reverse are unfit; ``strict`` also rejects
    nested fields that the schema lacks. Other unknown fields are dropped.
    """
    node = F.col("_node")
    malformed = ~F.coalesce(F.schema_of_variant(node).startswith("OBJECT"), F.lit(False))
    nested = [has_bad_node(F.try_variant_get(node, f'$["{f.name}"]', "variant"), f.dataType, strict) for f in schema.fields]
    unfit = reduce(lambda a, b: a | b, nested, F.lit(False))
    reason = F.when(malformed, F.lit("malformed_json")).when(unfit, F.lit("type_mismatch"))
    parsed = lines.withColumn("_node", F.try_parse_json("value"))
    return parsed.withColumns({"record": typed_node(node, schema), "reason": reason}).drop("_node")


def typed(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """Records with their fetch time and file."""
    leaves = [F.col("record").getField(f.name).alias(f.name) for f in schema.fields]
    fetched = F.coalesce(ingest_ts(F.col("object_key")), F.col("modified_at"))
    return parsed.select(*leaves, fetched.alias("ingest_ts"), "object_key")


def detected_fields(lines: DataFrame) -> DataFrame:
    """(field, kind) of the top-level fields of well-formed files.

    The kind, as schema_of_variant tells it, is that of the first file by
    object key in which the field is not always null.
    """
    nodes = lines.select("object_key", F.try_parse_json("value").alias("_node"))
    well_formed = F.coalesce(F.schema_of_variant("_node").startswith("OBJECT"), F.lit(False))
    broken = nodes.filter(~well_formed).select("object_key").distinct()
    entries = F.explode(F.try_variant_get(F.col("_node"), "$", "map<string,variant>")).alias("field", "_value")
    fields = nodes.filter(well_formed).join(broken, "object_key", "left_anti").select("object_key", entries)
    kinds = fields.groupBy("field", "object_key").agg(F.schema_of_variant_agg("_value").alias("kind"))
    known = kinds.filter("kind <> 'VOID'")
    return known.groupBy("field").agg(F.min_by("kind", "object_key").alias("kind"))


def detect(lines: DataFrame, known: T.StructType | None) -> T.StructType:
    """The columns of a table without a contract: those it has, and the new ones of its next files."""
    fields = list(known or [])
    names = {f.name.lower() for f in fields}
    # one row per field
    for row in detected_fields(lines).orderBy("field").collect():
        if row.field.lower() not in names:
            names.add(row.field.lower())
            fields.append(T.StructField(row.field, sql_type(row.kind)))
    return T.StructType(fields)


def file_summary(parsed: DataFrame) -> DataFrame:
    """Line count and, for a file with a bad line, the reason."""
    return parsed.groupBy("object_key").agg(
        F.count(F.lit(1)).alias("lines"), F.max("reason").alias("reason"), F.max("file_path").alias("file_path")
    )


def split_quarantine(parsed: DataFrame, files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines of wholly good files, and all lines of files with a bad one."""
    files = file_summary(parsed) if files is None else files
    bad = files.filter(F.col("reason").isNotNull()).select("object_key", F.col("reason").alias("file_reason"))
    good = parsed.join(bad, "object_key", "left_anti")
    return good, parsed.join(bad, "object_key")


# --- loading --------------------------------------------------------------------------------


def load_target(
    lines: DataFrame, source: str, endpoint: str, warehouse: Warehouse, batch: str, now: Column | None = None
) -> None:
    """Append the good files to the raw table, quarantine the others, write the audit.

    The lines are parsed once; the typed rows are written to the scratch area,
    where the files are judged. Without a contract the table takes its columns
    from the first file, by object key, that has them; later files have to fit
    them and may bring further ones.
    """
    spark = lines.sparkSession
    now = F.current_timestamp() if now is None else now
    target = f"{source}_{endpoint.lower()}"
    contract = schema_for(source, endpoint)
    with scratch_scope(spark):
        schema = contract or detect(lines, warehouse.types_of("raw", target))
        if not schema.fields:
            # no line of any file is a JSON object, so there is no table yet
            schema = T.StructType([T.StructField("_none", T.StringType())])
        parsed = materialise(parse(lines, schema, strict=contract is None).drop("value"), "parsed")
        files = materialise(file_summary(parsed), "lake_files")
        rejected = not files.filter(F.col("reason").isNotNull()).isEmpty()
        good, _ = split_quarantine(parsed, files) if rejected else (parsed, None)
        rows = typed(good, schema).drop("_none")
        warehouse.append("raw", target, rows, batch, warehouse.partition_of(source, endpoint.lower()))

        loaded = warehouse.appended("raw", target).filter(F.col(BATCH) == batch)
        written = loaded.groupBy("object_key").agg(F.count(F.lit(1)).alias("written"))
        outcome = files.withColumn("moved", F.lit(True))
        if rejected:
            # a file may have vanished since it was judged: only what reached the quarantine counts
            bad = files.filter(F.col("reason").isNotNull()).select("object_key", F.col("reason").alias("file_reason"))
            quarantine(lines.join(bad, "object_key"), warehouse, batch, now)
            outcome = files.join(quarantined_keys(warehouse, batch), "object_key", "left")
        outcome = outcome.join(written, "object_key", "left")
        good_file = F.col("reason").isNull() & F.col("written").isNotNull()
        event = F.when(good_file, "loaded").when(F.col("reason").isNull(), "load_miss").when(F.col("moved"), "quarantined").otherwise("quarantine_miss")
        audit = outcome.select(
            event.alias("event"),
            F.when(good_file, "INFO").otherwise("ERROR").alias("severity"),
            F.lit(SERVICE).alias("service"),
            "object_key",
            F.lit(source).alias("source"),
            F.lit(endpoint).alias("endpoint"),
            F.lit(target).alias("target_table"),
            F.coalesce("written", F.lit(0).cast("long")).alias("output_rows"),
            F.lit("file" if contract else "autodetect").alias("schema_source"),
            "reason",
            now.alias("logged_at"),
        )
        write_audit(warehouse, audit, f"{batch}-{target}")


def quarantine(bad: DataFrame, warehouse: Warehouse, batch: str, now: Column) -> None:
    rows = bad.select(
        F.concat(F.lit(QUARANTINE_PREFIX), "object_key").alias("object_key"),
        F.col("object_key").alias("moved_from"),
        "value",
        F.col("file_reason").alias("reason"),
        now.alias("quarantined_at"),
        now.cast("date").alias("quarantined_on"),
    )
    warehouse.append("raw", "raw_quarantine", rows, batch, ("quarantined_on",))


def quarantined_keys(warehouse: Warehouse, batch: str) -> DataFrame:
    """Keys whose lines really reached the quarantine in this batch."""
    rows = warehouse.appended("raw", "raw_quarantine")
    moved = rows.filter(F.col(BATCH) == batch).select(F.col("moved_from").alias("object_key")).distinct()
    return moved.withColumn("moved", F.lit(True))


def load_lines(lines: DataFrame, warehouse: Warehouse, batch: str, now: Column | None = None) -> None:
    """Load the lines of one micro-batch, which may belong to several targets.

    Files that another load has finished are left out; only the audit rows of
    the days in the keys of this batch are read for that.
    """
    spark = lines.sparkSession
    with scratch_scope(spark):
        lines = materialise(lines, "batch_lines")
        keys = materialise(lines.select("object_key").distinct(), "batch_files")
        # one row per day
        days = [r[0] for r in keys.select(key_day(F.col("object_key"))).distinct().collect()]
        done = finished_files(warehouse, days).filter(~F.col(BATCH).startswith(f"{batch}-"))
        pending = route(pending_files(keys, done))
        routed = materialise(pending, "pending_files")
        # one row per endpoint
        for row in routed.filter(F.col("skip_reason").isNull()).select("source", "endpoint").distinct().collect():
            mine = routed.filter((F.col("source") == row.source) & (F.col("endpoint") == row.endpoint))
            wanted = lines.join(mine.select("object_key"), "object_key", "left_semi")
            load_target(wanted, row.source, row.endpoint, warehouse, f"{batch}-{row.source}-{row.endpoint}", now)
        _audit_skipped(routed.filter(F.col("skip_reason").isNotNull()), warehouse, batch, now)


def _audit_skipped(objects: DataFrame, warehouse: Warehouse, batch: str, now: Column | None) -> None:
    skipped = objects.select("object_key", F.col("skip_reason").alias("reason")).distinct()
    if skipped.isEmpty():
        return
    rows = skipped.select(
        F.lit("skipped").alias("event"),
        F.lit("INFO").alias("severity"),
        F.lit(SERVICE).alias("service"),
        "object_key",
        F.lit(0).alias("output_rows"),
        "reason",
        (F.current_timestamp() if now is None else now).alias("logged_at"),
    )
    write_audit(warehouse, rows, f"{batch}-skipped")


def finished_files(warehouse: Warehouse, days: Sequence[str] | None = None) -> DataFrame:
    """The audit rows of files that need no other load; ``days`` limits them to keys of these days."""
    done = audit_log(warehouse).filter(F.col("event").isin(*FINISHED) & (F.col("service") == SERVICE))
    return done if days is None else done.filter(F.col(KEY_DAY).isin(list(days)))


def pending_files(objects: DataFrame, audit: DataFrame) -> DataFrame:
    """The objects of a lake that no audit row calls finished."""
    done = audit.filter(F.col("event").isin(*FINISHED)).select("object_key").distinct()
    return objects.join(done, "object_key", "left_anti")


def _objects(spark: SparkSession, lake_root: str) -> DataFrame:
    """The objects of a lake: a listing only, as the content column is pruned."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    return listing.load(lake_root).select(object_key(F.col("path"), lake_root).alias("object_key"), "path")


def _read_present(spark: SparkSession, paths: Sequence[str], lake_root: str) -> DataFrame | None:
    """The lines of those of ``paths`` that still exist; the lake is listed again only if one does not."""
    try:
        return read_lines(spark, paths, lake_root)
    except AnalysisException:
        there = _objects(spark, lake_root).filter(F.col("path").isin(list(paths))).select("path").collect()
        return read_lines(spark, [r.path for r in there], lake_root) if there else None


def load_batch(spark: SparkSession, lake_root: str, warehouse: Warehouse, batch: str | None = None) -> dict:
    """Load every file of the lake that no earlier load has finished, one endpoint after the other.

    Files are read by name, a bounded number at a time, in the order of their
    keys. A file without a line is finished as well. Quarantined rows beyond
    their retention are dropped at the end.
    """
    batch = batch or f"batch-{uuid.uuid4().hex}"
    with scratch_scope(spark):
        objects = materialise(route(pending_files(_objects(spark, lake_root), finished_files(warehouse))), "lake_objects")
        loadable = objects.filter(F.col("skip_reason").isNull())
        for row in loadable.select("source", "endpoint").distinct().collect():
            mine = loadable.filter((F.col("source") == row.source) & (F.col("endpoint") == row.endpoint))
            paths = (r.path for r in mine.select("path", "object_key").orderBy("object_key").toLocalIterator())
            for part, chosen in enumerate(iter(lambda: list(islice(paths, FILES_PER_LOAD)), [])):
                lines = _read_present(spark, chosen, lake_root)
                if lines is not None:
                    load_target(lines, row.source, row.endpoint, warehouse, f"{batch}-{row.source}-{row.endpoint}-{part}")
        # what is still there but gave no line
        seen = audit_log(warehouse).filter(F.col(BATCH).startswith(f"{batch}-")).select("object_key").distinct()
        blank = loadable.join(seen, "object_key", "left_anti")
        if not blank.isEmpty():
            blank = blank.join(_objects(spark, lake_root).select("path"), "path", "left_semi")
            blank = materialise(blank.withColumn("skip_reason", F.lit("no_lines")), "blank_files")
            objects = objects.unionByName(blank)
        _audit_skipped(objects.filter(F.col("skip_reason").isNotNull()), warehouse, batch, None)
    warehouse.purge_quarantine(dt.datetime.now(dt.timezone.utc).date())
    return run_summary(warehouse, batch)


def compact(warehouse: Warehouse, source: str, endpoint: str) -> int:
    """Fold the loads of a raw table into one, session by session; returns how many there were."""
    return warehouse.fold("raw", f"{source}_{endpoint.lower()}")


def run_summary(warehouse: Warehouse, batch: str) -> dict:
    """Endpoints, files and rows of one load."""
    audit = audit_log(warehouse).filter(F.col(BATCH).startswith(f"{batch}-"))
    loaded = F.col("event") == "loaded"
    row = audit.agg(
        F.sort_array(F.collect_set(F.when(loaded, F.col("endpoint")))).alias("endpoints"),
        F.count_if(loaded).alias("files_loaded"),
        F.count_if(F.col("event").isin("quarantined", "quarantine_miss", "load_miss")).alias("files_quarantined"),
        F.count_if(F.col("event") == "skipped").alias("files_skipped"),
        F.coalesce(F.sum("output_rows"), F.lit(0)).alias("rows_loaded"),
    ).first()
    return row.asDict()
