"""The landing zone: JSON documents under deterministic, date-partitioned paths.

A rerun of an interval overwrites its own document. Readers never infer a schema. Each row
carries the path it came from, relative to the landing root, as its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas

# The folders of the four kinds of document.
PLAYER_COUNTS = "raw/player-counts"
APP_LIST = "raw/app-list"
MOST_PLAYED = "raw/most-played"
APP_DETAILS = "raw/app-details"

# Fixed value: times in documents keep their microseconds and their offset.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Documents of one interval that one task writes.
DOCUMENTS_PER_TASK = 5_000


def _day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


# The four keys, fixed formats.


def player_counts_key(ts: Column) -> Column:
    return F.concat(
        F.lit(f"{PLAYER_COUNTS}/dt="), _day(ts), F.date_format(ts, "'/'HH'-snapshot.json'")
    )


def app_list_key(ts: Column) -> Column:
    return F.concat(F.lit(f"{APP_LIST}/dt="), _day(ts), F.lit("/app-list.json"))


def most_played_key(ts: Column) -> Column:
    return F.concat(F.lit(f"{MOST_PLAYED}/dt="), _day(ts), F.lit("/most-played.json"))


def app_details_key(ts: Column, app_id: Column) -> Column:
    return F.concat(
        F.lit(f"{APP_DETAILS}/dt="), _day(ts), F.lit("/"), app_id.cast("string"), F.lit(".json")
    )


def read_documents(
    spark: SparkSession, root: str, kind: str, schema: T.StructType, key: str = "s3_key"
) -> DataFrame:
    """All documents of a kind, with `dt` from the path and the document's key.

    `dt` is a partition column, so a filter on it decides which folders are listed and read.
    """
    with_day = T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
    documents = spark.read.schema(with_day).json(f"{root}/{kind}")
    return documents.withColumn(key, key_of("_metadata.file_path", kind))


def key_of(path: str, kind: str) -> Column:
    """The part of a full path from the kind's folder on."""
    return F.regexp_extract(F.url_decode(path), f"({kind}/.*)$", 1)


def read_bundles(spark: SparkSession, root: str) -> DataFrame:
    return read_documents(spark, root, PLAYER_COUNTS, schemas.BUNDLE)


def read_app_list(spark: SparkSession, root: str) -> DataFrame:
    """One row per listed app, with the position that decides between repeated ids.

    An interval may hold several documents, one per page.
    """
    pages = read_documents(spark, root, APP_LIST, schemas.APP_LIST)
    return pages.select("dt", "s3_key", F.posexplode("apps").alias("position", "app")).select(
        "dt",
        F.col("app.appid").alias("app_id"),
        F.col("app.name").alias("name"),
        F.struct("s3_key", "position").alias("position"),
    )


def read_chart(spark: SparkSession, root: str) -> DataFrame:
    """One row per chart entry, in chart order."""
    documents = read_documents(spark, root, MOST_PLAYED, schemas.MOST_PLAYED)
    return documents.select(
        "dt", F.posexplode("most_played").alias("position", "entry")
    ).select("dt", "position", F.col("entry.appid").alias("app_id"))


def read_details(spark: SparkSession, root: str) -> DataFrame:
    return read_documents(spark, root, APP_DETAILS, schemas.APP_DETAILS)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def spread(documents: DataFrame, interval: Sequence[str], parts: Sequence[str] = ()) -> DataFrame:
    """Documents dealt out to tasks by interval, a large interval over as many tasks as its number
    of documents asks for.

    The documents of each interval are counted first, which reads the interval's columns only.
    Within an interval a document goes by its `parts` and a hash of its contents, so a task that
    is run again gets the same documents.
    """
    spark = documents.sparkSession
    counts = documents.groupBy(*interval).agg(F.count(F.lit(1)).alias("__documents"))
    total, groups = counts.agg(F.sum("__documents"), F.count(F.lit(1))).first()
    tasks = max(1, -(-(total or 0) // DOCUMENTS_PER_TASK))
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = counts.filter(F.col("__documents") > DOCUMENTS_PER_TASK).select(
        *[F.col(c).alias(f"__{c}") for c in interval],
        F.ceil(F.col("__documents") / DOCUMENTS_PER_TASK).alias("__tasks"),
    )
    fields = [f.name for f in documents.schema.fields if _hashable(f.dataType)]
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in interval]
    # Few intervals are large: the others are not in this table.
    salted = documents.join(large, same, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*fields), F.coalesce("__tasks", F.lit(1)))
    )
    dealt = salted.repartition(max(tasks, min(groups, usual), 1), *interval, *parts, "__salt")
    return dealt.select(*documents.columns)


def write_documents(
    documents: DataFrame,
    root: str,
    kind: str,
    interval: Sequence[str],
    parts: Sequence[str] = (),
) -> None:
    """Write one JSON document per row into the folder of its interval.

    An interval that is written again is replaced, the others stay, so the caller names it: a
    kind that lands hourly must have the hour among its columns, or one hour would replace the
    rest of its day. Documents are spread over tasks by `spread`: an interval with very many is
    no one task's, whether or not the caller names `parts` that divide it.
    The output committer publishes a task's files when the task succeeds, so a lost executor
    leaves nothing behind.
    """
    (
        spread(documents, interval, parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("timestampFormat", TIME_FORMAT)
        .partitionBy(*interval)
        .json(f"{root}/{kind}")
    )
