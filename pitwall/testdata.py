"""Motorsport-shaped raw tables derived from the driver's test tables.

Every key space grows with the input: 1,000 consecutive events make a session,
20 consecutive orders a race and 24 races a season. The groups that an adapter
has to number are therefore bounded by construction, at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.session import tune

FIRST_SESSION = 11230
EVENTS_PER_SESSION = 1000
CARS = 20
FIRST_SEASON = 1950
ORDERS_PER_RACE = 20
RACES_PER_SEASON = 24
PAGE_ROWS = 100
# Orders of the seasons in one task, which sorts and collects them several times.
ORDERS_PER_TASK = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- timing feed, from events ---------------------------------------------------------------


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their session and car, co-located per session."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.expr(f"event_id div {EVENTS_PER_SESSION} + {FIRST_SESSION}").alias("session_key"),
        (F.col("user_id") % CARS).alias("driver_number"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        "event_type",
        "value",
    )


def raw_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only laps table: every lap, and the copies of repeated polls.

    Copy 1 is older and must lose; copy 2 is an amendment with the same start
    time and a later fetch, and must win.
    """
    events = timed_events(spark, sf_dir).repartition("session_key")
    in_order = Window.partitionBy("session_key", "driver_number").orderBy("ts", "event_id")
    event_id = F.col("event_id")
    base = events.select(
        "session_key",
        "driver_number",
        F.row_number().over(in_order).cast("long").alias("lap_number"),
        F.when((F.col("event_type") == "signup") & (event_id % 5 == 0), F.lit(None))
        .otherwise(F.lit(60.0) + F.col("value"))
        .alias("lap_duration"),
        F.when(event_id % 11 == 0, F.lit(None))
        .otherwise((F.col("event_type") == "error") & (event_id % 3 == 0))
        .alias("is_pit_out_lap"),
        "ts",
        "event_id",
    )
    copies = F.filter(
        F.array(F.lit(0), F.when(event_id % 4 == 0, F.lit(1)), F.when(event_id % 9 == 0, F.lit(2))),
        lambda c: c.isNotNull(),
    )
    copy = F.col("copy")
    shift = F.when(copy == 1, F.lit(1.0)).when(copy == 2, F.lit(-0.25)).otherwise(F.lit(0.0))
    seconds = F.col("lap_duration") + shift
    polled = base.withColumn("copy", F.explode(copies))
    return polled.select(
        "session_key",
        F.col("session_key").alias("meeting_key"),
        "driver_number",
        "lap_number",
        F.when(copy == 1, F.col("ts") - F.expr("interval 1 second")).otherwise(F.col("ts")).alias("date_start"),
        seconds.alias("lap_duration"),
        (seconds * F.lit(0.3)).alias("duration_sector_1"),
        (seconds * F.lit(0.4)).alias("duration_sector_2"),
        (seconds * F.lit(0.3)).alias("duration_sector_3"),
        (F.lit(250) + event_id % 80).alias("i1_speed"),
        (F.lit(260) + event_id % 70).alias("i2_speed"),
        (F.lit(270) + event_id % 60).alias("st_speed"),
        "is_pit_out_lap",
        (F.col("ts") + F.expr("make_interval(0, 0, 0, 0, 0, copy + 1, 0)")).alias("ingest_ts"),
    )


def raw_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stints per (session, car), with open, unknown and overlapping ones."""
    cars = timed_events(spark, sf_dir).select("session_key", "driver_number").distinct()
    car, stint = F.col("driver_number"), F.col("stint.n")
    plan = F.array(*[_stint(*s) for s in [(1, 1, 15, 0), (2, 16, 32, 0), (3, 33, 99, 0), (1, 1, None, 1)]])
    rows = cars.withColumn("stint", F.explode(plan)).filter((F.col("stint.copy") == 0) | (car % 2 == 0))
    tyre = (car + stint) % 3
    return rows.select(
        "session_key",
        F.col("session_key").alias("meeting_key"),
        "driver_number",
        stint.alias("stint_number"),
        F.when((car == 9) & (stint == 2), F.lit(14).cast("long")).otherwise(F.col("stint.lo")).alias("lap_start"),
        F.when((car % 5 == 3) & (stint == 3), F.lit(None)).otherwise(F.col("stint.hi")).alias("lap_end"),
        F.when((car == 7) & (stint == 2), F.lit(None))
        .when(tyre == 0, F.lit("SOFT"))
        .when(tyre == 1, F.lit("MEDIUM"))
        .otherwise(F.lit("HARD"))
        .alias("compound"),
        (car % 4).alias("tyre_age_at_start"),
    )


def _stint(n: int, lo: int, hi: int | None, copy: int) -> Column:
    return F.struct(
        F.lit(n).cast("long").alias("n"),
        F.lit(lo).cast("long").alias("lo"),
        F.lit(hi).cast("long").alias("hi"),
        F.lit(copy).alias("copy"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session list; every fifth session has no end yet."""
    spans = timed_events(spark, sf_dir).groupBy("session_key").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return spans.select(
        "session_key",
        F.col("lo").alias("date_start"),
        F.when(F.col("session_key") % 5 != 0, F.col("hi")).alias("date_end"),
    )


def lake_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys as they appear in the lake, one per event."""
    stamped = timed_events(spark, sf_dir).selectExpr(
        "*", """date_format(ts, "yyyyMMdd'T'HHmmss'Z'") as stamp""", "date_format(ts, 'yyyy-MM-dd') as day"
    )
    paged = stamped.selectExpr("*", "'season=' || (2023 + event_id % 3) || '-page' || event_id % 5 * 100 || '-' || stamp || '.ndjson' as page_file")
    return paged.selectExpr(
        "event_id",
        """case event_id % 6
             when 0 then 'raw/source=ergast/endpoint=driverStandings/dt=' || day || '/' || page_file
             when 1 then 'raw/source=openf1/endpoint=laps/session=' || session_key || '/' || stamp || '.ndjson'
             when 2 then 'raw/source=openf1/endpoint=stints/session=' || session_key || '/' || stamp || '.ndjson'
             when 3 then 'raw_quarantine/raw/source=openf1/endpoint=laps/session=' || session_key || '/x.ndjson'
             when 4 then 'raw/source=ergast/endpoint=results/dt=' || day || '/' || page_file
             else 'other/' || session_key end as object_key""",
    )


def lake_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON lines of lap files, ten to a file; some are broken or do not fit the contract."""
    e = timed_events(spark, sf_dir).withColumn("number", F.expr("if(event_id % 101 = 0, 'R', string(event_id))"))
    record = """to_json(named_struct(
      'session_key', session_key,
      'driver_number', string(driver_number),
      'lap_number', number,
      'lap_duration', if(event_id % 7 = 0, null, string(60.0D + value)),
      'date_start', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") || '+00:00',
      'is_pit_out_lap', event_type = 'error',
      'unknown', array(event_id, null)))"""
    return e.selectExpr(
        f"if(event_id % 97 = 0, '{{\"session_key\": 1, ', {record}) as value",
        "'raw/source=openf1/endpoint=laps/session=' || session_key || '/' || event_id div 10 || '.ndjson' as object_key",
        "'' as file_path",
        "ts as modified_at",
        "event_id",
    )


def stint_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON lines of stint files, ten to a file; some hold an object or a list in place of a text."""
    record = """to_json(named_struct(
      'session_key', session_key, 'driver_number', driver_number, 'stint_number', event_id % 10 + 1,
      'lap_start', string(event_id % 50), 'lap_end', event_id % 50 + 10, 'tyre_age_at_start', 0))"""
    compound = """case when event_id % 53 = 0 then '{"x":1}' when event_id % 59 = 0 then '["SOFT"]'
      when event_id % 61 = 0 then '5' when event_id % 67 = 0 then 'null' else '"SOFT"' end"""
    return timed_events(spark, sf_dir).selectExpr(
        f"rtrim('}}', {record}) || ',\"compound\":' || {compound} || '}}' as value",
        "'raw/source=openf1/endpoint=stints/session=' || session_key || '/' || event_id div 10 || '.ndjson' as object_key",
        "'' as file_path",
        "ts as modified_at",
        "event_id",
    )


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON lines of an endpoint without a contract, ten to a file.

    A third of the files has one more field; some lines are broken, have a text
    in place of a number, or a nested field that others lack.
    """
    wind = "if(event_id % 71 = 0, named_struct('speed', event_id % 9, 'gust', 1L), named_struct('speed', event_id % 9, 'gust', bigint(null)))"
    record = f"""to_json(named_struct(
      'session_key', session_key, 'temp', event_id % 40, 'wind', {wind},
      'rain', if(event_id div 10 % 3 = 0, event_id % 2 = 0, null)))"""
    hot = f"if(event_id % 89 = 0, replace({record}, '\"temp\":' || event_id % 40, '\"temp\":\"hot\"'), {record})"
    return timed_events(spark, sf_dir).selectExpr(
        f"if(event_id % 97 = 0, '[1, ', {hot}) as value",
        "'raw/source=openf1/endpoint=weather/session=' || session_key || '/' || event_id div 10 || '.ndjson' as object_key",
        "'' as file_path",
        "ts as modified_at",
        "event_id",
    )


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = timed_events(spark, sf_dir)
    return e.select(
        F.concat(F.lit("raw_quarantine/"), F.col("event_id").cast("string")).alias("object_key"),
        F.col("event_type").alias("reason"),
        F.col("ts").alias("quarantined_at"),
    )


# Services of the derived log that alerts watch.
SERVICES = ("loader", "landing", "build")


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events of the services; error events have severity ERROR."""
    e = timed_events(spark, sf_dir)
    car = F.col("driver_number")
    service = (
        F.when(car % 4 == 0, F.lit(SERVICES[0]))
        .when(car % 4 == 1, F.lit(SERVICES[1]))
        .when(car % 4 == 2, F.lit(SERVICES[2]))
        .otherwise(F.lit("somebody-else"))
    )
    severity = F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
    return e.select(service.alias("service"), severity.alias("severity"), F.col("ts").alias("logged_at"))


# --- season results, from orders and customers ----------------------------------------------


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (season, round, driver), co-located per season.

    Each ten seasons have their own 40 drivers. The number of tasks follows that
    of the orders, not their bytes, as packed orders take many times their size.
    """
    per_season = ORDERS_PER_RACE * RACES_PER_SEASON
    season_no = f"(o_orderkey div {per_season})"
    all_orders = table(spark, sf_dir, "orders")
    tasks = 1 + all_orders.count() // ORDERS_PER_TASK
    orders = all_orders.select(
        F.expr(f"{season_no} + {FIRST_SEASON}").alias("season"),
        F.expr(f"o_orderkey % {per_season} div {ORDERS_PER_RACE} + 1").alias("round"),
        F.expr(f"{season_no} div 10 * 40 + o_custkey % 40").alias("driver_no"),
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
    )
    grouped = (
        orders.repartition(tasks, "season")
        .groupBy("season", "round", "driver_no")
        .agg(
            F.max("o_totalprice").alias("price"),
            F.min("o_totalprice").alias("low_price"),
            (F.min("o_orderkey") % 20 + 1).alias("grid"),
            (F.count(F.lit(1)) + 50).alias("laps"),
            # a number keeps the hash aggregate, a string would need a sorted one
            F.expr("chr(max(ascii(o_orderstatus)))").alias("status"),
        )
    )
    race = Window.partitionBy("season", "round")
    return grouped.select(
        "season",
        "round",
        "driver_no",
        F.concat(F.lit("d"), F.col("driver_no").cast("string")).alias("driver_id"),
        F.concat(F.lit("t"), ((F.col("driver_no") + F.col("season")) % 10).cast("string")).alias("constructor_id"),
        F.row_number().over(race.orderBy(F.desc("price"), "driver_no")).cast("long").alias("position"),
        F.row_number().over(race.orderBy("low_price", "driver_no")).cast("long").alias("qualifying_position"),
        "grid",
        "laps",
        "status",
    ).withColumn("points", F.greatest(F.lit(0).cast("long"), F.lit(26) - F.col("position")))


def _race(season: str, round_: str, entries_field: str, entry_list: str) -> str:
    return f"""named_struct(
      'season', {season},
      'round', {round_},
      'raceName', 'Race ' || {round_},
      'date', date_add(date '2000-01-01', cast({round_} * 14 as int)),
      'url', 'http://race/' || {season} || '/' || {round_},
      'Circuit', named_struct(
        'circuitId', 'c' || {round_},
        'circuitName', 'Circuit ' || {round_},
        'Location', named_struct('country', 'Country ' || {round_})),
      '{entries_field}', {entry_list})"""


def _race_pages(rows: DataFrame, entries_field: str) -> DataFrame:
    """Pages of 100 entries per season, each landed twice.

    A race whose entries cross a page boundary appears on both pages, with a
    part of them on each.
    """
    paged = rows.selectExpr(
        "season",
        "round",
        "entry",
        f"(row_number() over (partition by season order by round, driver_no) - 1) div {PAGE_ROWS} as page",
        "count(entry) over (partition by season) as total",
    )
    races = paged.groupBy("season", "page", "total", "round").agg(F.collect_list("entry").alias("entries"))
    race = F.expr(_race("season", "round", entries_field, "entries"))
    pages = races.groupBy("season", "page", "total").agg(F.collect_list(race).alias("Races"))
    return pages.selectExpr(
        "total",
        f"bigint({PAGE_ROWS}) as limit",
        f"page * {PAGE_ROWS} as offset",
        "named_struct('season', season, 'Races', Races) as RaceTable",
        "explode(array(0, 1)) as copy",
    ).drop("copy")


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages; the last race of each season is announced, not driven yet."""
    driven = entries(spark, sf_dir).selectExpr(
        "season",
        "round",
        "driver_no",
        """named_struct(
          'position', position, 'points', points, 'grid', grid, 'laps', laps, 'status', status,
          'Driver', named_struct('driverId', driver_id),
          'Constructor', named_struct('constructorId', constructor_id)) as entry""",
    )
    pages = _race_pages(driven, "Results")
    announced = _race("r.season", f"bigint({RACES_PER_SEASON + 1})", "Results", "filter(r.Results, e -> false)")
    template = "slice(RaceTable.Races, 1, if(offset = 0, 1, 0))"
    return pages.withColumn(
        "RaceTable",
        F.expr(
            "named_struct('season', RaceTable.season,"
            f" 'Races', concat(RaceTable.Races, transform({template}, r -> {announced})))"
        ),
    )


def raw_qualifying(spark: SparkSession, sf_dir: str) -> DataFrame:
    took_part = entries(spark, sf_dir).filter("(season + round + driver_no) % 10 <> 0")
    rows = took_part.selectExpr(
        "season",
        "round",
        "driver_no",
        """named_struct(
          'position', qualifying_position,
          'Driver', named_struct('driverId', driver_id),
          'Constructor', named_struct('constructorId', constructor_id),
          'Q1', '1:20.' || qualifying_position,
          'Q2', if(qualifying_position <= 15, '1:19.' || qualifying_position, null),
          'Q3', if(qualifying_position <= 10, '1:18.' || qualifying_position, null)) as entry""",
    )
    return _race_pages(rows, "QualifyingResults")


def raw_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    drivers = table(spark, sf_dir, "customer").selectExpr(
        f"c_custkey div {PAGE_ROWS} as page",
        """named_struct(
          'driverId', 'd' || c_custkey,
          'code', substr(c_mktsegment, 1, 3),
          'permanentNumber', c_custkey % 99 + 1,
          'givenName', if(c_custkey % 17 <> 0, substr(c_name, 1, 8), null),
          'familyName', substr(c_name, 10, 9),
          'dateOfBirth', date_add(date '1980-01-01', cast(c_custkey % 7000 as int)),
          'nationality', 'N' || c_nationkey,
          'url', 'http://driver/' || c_custkey) as driver""",
    )
    pages = drivers.groupBy("page").agg(F.collect_list("driver").alias("drivers"))
    return pages.selectExpr(
        f"bigint({PAGE_ROWS}) as limit",
        f"page * {PAGE_ROWS} as offset",
        f"named_struct('season', bigint({FIRST_SEASON}), 'Drivers', drivers) as DriverTable",
        "explode(array(0, 1)) as copy",
    ).drop("copy")


def raw_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standings after every round; some drivers have no or two constructors."""
    so_far = "over (partition by season, driver_no order by round rows between unbounded preceding and current row)"
    sums = entries(spark, sf_dir).selectExpr(
        "*", f"sum(points) {so_far} as total_points", f"sum(bigint(position = 1)) {so_far} as wins"
    )
    standings = sums.selectExpr(
        "season",
        "round",
        """named_struct(
          'position', bigint(row_number() over (partition by season, round order by total_points desc, driver_no)),
          'points', total_points,
          'wins', wins,
          'Driver', named_struct('driverId', driver_id),
          'Constructors', filter(
            array(named_struct('constructorId', constructor_id), named_struct('constructorId', 'other')),
            (team, i) -> driver_no % 13 <> 5 and (i = 0 or driver_no % 7 = 2))) as standing""",
    )
    lists = standings.groupBy("season", "round").agg(F.collect_list("standing").alias("standings"))
    return lists.selectExpr(
        """named_struct(
          'season', season, 'round', round,
          'StandingsLists', array(
            named_struct('season', season, 'round', round, 'DriverStandings', standings))) as StandingsTable""",
        "explode(array(0, 1)) as copy",
    ).drop("copy")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of landed result pages, some lost and some with a bad total."""
    rows = entries(spark, sf_dir)
    in_season = Window.partitionBy("season")
    page = F.expr(f"(row_number() over (partition by season order by round, driver_no) - 1) div {PAGE_ROWS}")
    pages = (
        rows.select("season", page.alias("page"), F.count(F.lit(1)).over(in_season).alias("n"))
        .groupBy("season", "page")
        .agg(F.max("n").alias("n"))
    )
    season, number = F.col("season"), F.col("page")
    landed = pages.filter((number == 0) | ((season + number) % 5 != 3))
    total = F.when(season % 11 == 4, F.lit("n/a")).when(season % 13 == 6, F.lit(None)).otherwise(F.col("n").cast("string"))
    return landed.select(
        F.lit("ergast").alias("source"),
        F.lit("results").alias("endpoint"),
        "season",
        total.alias("total"),
        (number * PAGE_ROWS).alias("offset"),
    )
