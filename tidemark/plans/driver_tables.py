"""The given tables seen as the model's inputs.

An event is an observation (entity `user_id`, value in cents), customers are the registry,
parts carry the storefront documents, orders rank the chart. Every frame covers its whole table.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.daily import dense_daily, trends
from tidemark.operators.ledger import hour_ledger, normalize_runs
from tidemark.operators.metadata import extract_metadata, unwrap_details
from tidemark.operators.observations import fact_native, normalize_observations
from tidemark.operators.registry import dim_entity, normalize_registry
from tidemark.plans.model import Raw
from tidemark.schemas import CATALOG_RUNS
from tidemark.sources.landing import player_counts_key
from tidemark.sources.sinks import settled
from tidemark.sources.tables import read_parquet_utc

# Schemas are declared and not read from footers, which would be a job per table and query.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

AS_OF = datetime(2024, 1, 30, 23, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_utc(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def to_observations(events: DataFrame, entity: str = "user_id") -> DataFrame:
    """Rows of the hourly raw table. Delay and latency are derived from the row itself."""
    delay = F.make_dt_interval(mins=(F.col("event_id") % 181).cast("int"))
    return events.select(
        F.col(entity).alias("app_id"),
        F.round(F.col("value") * 100).cast("bigint").alias("player_count"),
        F.col("ts").alias("logical_hour"),
        (F.col("ts") + delay).alias("observed_at"),
        player_counts_key(F.col("ts")).alias("s3_key"),
        F.lit(AS_OF).cast("timestamp").alias("loaded_at"),
        (F.col("event_id") * 37 % 900_000).cast("int").alias("latency_ms"),
        "event_id",
        "event_type",
    )


def observations(spark: SparkSession, sf_dir: str, entity: str = "user_id") -> DataFrame:
    return to_observations(table(spark, sf_dir, "events"), entity)


def fact(spark: SparkSession, sf_dir: str, entity: str = "user_id") -> DataFrame:
    return fact_native(normalize_observations(observations(spark, sf_dir, entity), carry=()))


def last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.to_date(F.max("ts")))


def daily(spark: SparkSession, sf_dir: str, entity: str = "user_id") -> DataFrame:
    return dense_daily(fact(spark, sf_dir, entity), last_day(spark, sf_dir))


def trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    stretched = dense_daily(fact(spark, sf_dir), last_day(spark, sf_dir), folded=True)
    return trends(stretched)


def registry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("app_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") == 0, "seed").otherwise("chart").alias("source"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp").alias("tracked_from"),
        (F.col("c_mktsegment") != "HOUSEHOLD").alias("is_active"),
    )


def details_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A storefront envelope per part, with the irregularities such documents have."""
    k = F.col("p_partkey")
    price = F.round(F.col("p_retailprice") * 100).cast("int")
    day = F.date_add(F.lit("2015-01-01").cast("date"), (k % 4000).cast("int"))
    date_text = (
        F.when(k % 5 == 3, "Q4 2026")
        .when(k % 5 == 4, "Feb 31, 2020")
        .otherwise(F.date_format(day, "MMM d, yyyy"))
    )
    words = F.transform(
        F.split("p_name", " "), lambda w: F.struct(F.lit(1).alias("id"), w.alias("description"))
    )
    data = F.struct(
        F.when(k % 500 == 7, k + 1).otherwise(k).alias("steam_appid"),
        F.col("p_name").alias("name"),
        F.when(k % 50 == 3, "dlc").otherwise("game").alias("type"),
        F.col("p_type").alias("short_description"),
        F.struct(
            F.when(k % 13 != 0, k % 11 == 0).alias("coming_soon"), date_text.alias("date")
        ).alias("release_date"),
        F.when(k % 6 == 1, F.slice(words, 1, 0)).when(k % 6 != 0, words).alias("genres"),
        F.when(k % 4 == 0, "0").when(k % 4 == 1, "17").when(k % 4 == 2, "17+").alias(
            "required_age"
        ),
        (k % 2 == 0).alias("is_free"),
        F.struct(
            F.lit(True).alias("windows"), (k % 3 == 0).alias("mac"), (k % 5 == 0).alias("linux")
        ).alias("platforms"),
        F.when(k % 3 != 0, F.struct((F.col("p_size") * 2).alias("score"))).alias("metacritic"),
        F.when(k % 4 != 1, F.struct(F.col("p_size").alias("total"))).alias("achievements"),
        F.when(k % 7 != 2, F.struct((k * 3).alias("total"))).alias("recommendations"),
        F.when(
            k % 2 == 1,
            F.struct(
                F.lit("USD").alias("currency"),
                price.alias("initial"),
                (price - (k % 100).cast("int")).alias("final"),
            ),
        ).alias("price_overview"),
    )
    success = F.col("p_brand") != "Brand#9"
    entry = F.struct(success.alias("success"), F.when(success, data).alias("data"))
    # A document is many times its row, and writing and reading it takes far longer than a scan: rows
    # are dealt out first, as many of them lie in the few bytes of one row group, and so in one task.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = table(spark, sf_dir, "part").repartition(partitions, "p_partkey")
    return parts.select(
        k.alias("app_id"), F.to_json(F.create_map(k.cast("string"), entry)).alias("envelope")
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_metadata(unwrap_details(details_raw(spark, sf_dir)).filter("success"))


def landed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(app_id, success, data) of all envelopes, opened once and written as variants.

    For jobs that read them several times: opening a document takes far longer than reading it.
    """
    return settled(unwrap_details(details_raw(spark, sf_dir)), "details")


# Two sides of an hour: these events are what a run says of itself, all others what it observed.
RUN_EVENTS = ("purchase", "error")


def side_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").filter(~F.col("event_type").isin(*RUN_EVENTS))
    return normalize_observations(to_observations(seen), carry=())


def event_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """The first and the last day of the events."""
    day = F.to_date("ts")
    first, last = table(spark, sf_dir, "events").agg(F.min(day), F.max(day)).first()
    return first or AS_OF.date(), last or AS_OF.date()


def day_after(spark: SparkSession, sf_dir: str) -> Column:
    """A day after the last event: the time at which the ledger is read."""
    last = table(spark, sf_dir, "events").agg(F.max("ts") + F.expr("interval 24 hours"))
    return last.scalar()


def runs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records per run: a first attempt that loaded nothing, then the one that counts.

    Purchases are what a run observed and loaded, errors are what failed. An hour
    without purchases has no run.
    """
    kind = F.col("event_type")
    per_hour = (
        table(spark, sf_dir, "events")
        .filter(kind.isin(*RUN_EVENTS))
        .groupBy(F.date_trunc("hour", "ts").alias("hour"))
        .agg(
            F.count_if(kind == "purchase").cast("int").alias("bought"),
            F.count_if(kind == "error").cast("int").alias("failed"),
        )
        .filter("bought > 0")
    )
    attempts = per_hour.withColumn("attempt", F.explode(F.array(F.lit(0), F.lit(1))))
    last = F.col("attempt") == 1
    return attempts.select(
        F.concat(
            F.lit("run-"), F.date_format("hour", "yyyyMMddHH"), F.lit("-"), F.col("attempt")
        ).alias("run_id"),
        (F.col("hour") + F.expr("interval 7 minutes") * F.col("attempt")).alias("logical_hour"),
        (F.col("bought") + F.col("failed")).alias("tracked_count"),
        F.when(last, F.col("bought")).otherwise(0).alias("observed_count"),
        F.array().cast("array<bigint>").alias("unobservable_app_ids"),
        F.when(last, F.col("bought")).otherwise(0).alias("loaded_count"),
        (F.col("bought") * 10 + 5).alias("latency_p50_ms"),
        (F.col("bought") * 20 + 5).alias("latency_max_ms"),
        player_counts_key(F.col("hour")).alias("s3_key"),
        (F.col("hour") + F.expr("interval 10 minutes") * (F.col("attempt") + 1)).alias(
            "recorded_at"
        ),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = normalize_runs(runs_raw(spark, sf_dir))
    observed = side_observations(spark, sf_dir)
    return hour_ledger(runs, observed, day_after(spark, sf_dir))


def day_evidence(daily_fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Days as runs: an entity without an hour that day is one the run could not observe."""
    hours = F.col("observed_hours")
    run_id = F.date_format("date_day", "yyyy-MM-dd").alias("run_id")
    runs = daily_fact.groupBy("date_day").agg(
        F.count_if(hours == 0).cast("int").alias("unobservable_count"),
        F.count_if(hours > 0).cast("int").alias("observed_count"),
    )
    runs = runs.select(
        run_id,
        F.col("date_day").cast("timestamp").alias("logical_hour"),
        F.col("date_day").cast("timestamp").alias("recorded_at"),
        "unobservable_count",
        "observed_count",
    )
    return runs, daily_fact.filter(hours == 0).select(run_id, "app_id")


def listing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a run record with a short id list, NULL on errors, empty on every third."""
    e, u = F.col("event_id"), F.col("user_id")
    ids = F.when(e % 3 == 0, F.array().cast("array<bigint>")).otherwise(
        F.sequence(u % 4, u % 4 + e % 5)
    )
    return table(spark, sf_dir, "events").select(
        e.cast("string").alias("run_id"),
        F.col("ts").alias("logical_hour"),
        (e % 11 + 5).cast("int").alias("tracked_count"),
        (e % 7).cast("int").alias("observed_count"),
        F.when(F.col("event_type") != "error", ids).alias("unobservable_app_ids"),
        F.lit(0).alias("loaded_count"),
        F.col("ts").alias("recorded_at"),
    )


def entity_dim(spark: SparkSession, sf_dir: str, n: int = 2) -> DataFrame:
    runs, unobservable = day_evidence(daily(spark, sf_dir))
    return dim_entity(
        normalize_registry(registry_raw(spark, sf_dir)),
        metadata(spark, sf_dir),
        runs,
        unobservable,
        n,
    )


def board_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as a board reads it: the registry with attributes already typed."""
    described = table(spark, sf_dir, "part").filter("p_brand <> 'Brand#9'").selectExpr(
        "p_partkey AS app_id",
        "p_name AS described_name",
        """CASE WHEN p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 5 <= 2
           THEN date_add(DATE '2015-01-01', CAST(p_partkey % 4000 AS INT)) END AS release_date""",
        "CASE WHEN p_partkey % 6 > 1 THEN split(p_name, ' ') END AS genre_names",
        "p_partkey % 2 = 0 AS is_free",
        """CASE WHEN p_partkey % 2 = 1 THEN CAST((CAST(round(p_retailprice * 100) AS BIGINT)
           - p_partkey % 100) / 100 AS DECIMAL(18, 2)) END AS price_final_usd""",
    )
    members = normalize_registry(registry_raw(spark, sf_dir))
    return (
        members.join(described, "app_id", "left")
        .withColumn("app_name", F.coalesce("described_name", "app_name"))
        .drop("described_name")
    )


def raw_tables(spark: SparkSession, sf_dir: str, details: DataFrame | None = None) -> Raw:
    """The five raw tables of the model. `details` are the opened envelopes, where they are kept."""
    now = F.lit(AS_OF).cast("timestamp")
    if details is None:
        details = unwrap_details(details_raw(spark, sf_dir))
    stored = details.filter("success")
    run = spark.createDataFrame([("scheduled-1",)], "run_id string")
    lists = [c for c in CATALOG_RUNS.fields if c.name not in ("run_id", "recorded_at")]
    return Raw(
        player_counts=observations(spark, sf_dir).select(
            "app_id", "player_count", "logical_hour", "observed_at", "s3_key", "loaded_at"
        ),
        tracked_universe=registry_raw(spark, sf_dir),
        app_metadata=stored.select(
            "app_id", "data", now.alias("first_loaded_at"), now.alias("updated_at")
        ),
        snapshot_runs=runs_raw(spark, sf_dir),
        catalog_runs=run.select(
            "run_id",
            *[F.lit(None).cast(c.dataType).alias(c.name) for c in lists],
            now.alias("recorded_at"),
        ),
    )
