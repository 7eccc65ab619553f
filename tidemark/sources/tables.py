"""Raw and mart tables kept as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


def read_parquet_utc(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Read Parquet; times without a zone are taken as UTC instants."""
    df = spark.read.schema(schema).parquet(path)
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def create_raw_tables(spark: SparkSession, root: str) -> None:
    """Create the raw tables that do not exist yet. Existing ones are left as they are.

    The hourly counts are partitioned by day, since loads and audits touch single days.
    """
    for name, schema in schemas.RAW_TABLES.items():
        if name == "player_counts":
            schema = T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
        writer = spark.createDataFrame([], schema).write.mode("ignore")
        if name == "player_counts":
            writer = writer.partitionBy("dt")
        writer.parquet(f"{root}/{name}")


def read_player_counts(spark: SparkSession, path: str) -> DataFrame:
    """The hourly counts with their `dt` partition column."""
    fields = [*schemas.PLAYER_COUNTS.fields, T.StructField("dt", T.DateType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run a query over frames given by name. The result stays a DataFrame."""
    return spark.sql(sql, **frames) if frames else spark.sql(sql)


def seed_frame(
    spark: SparkSession, app_ids: tuple[int, ...] = schemas.SEED_APP_IDS
) -> DataFrame:
    """The curated ids as rows."""
    return spark.createDataFrame([(i,) for i in app_ids], "app_id bigint")
