"""Typed columns out of storefront documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.documents import text_at, texts_in, value_at
from tidemark.functions.exact import cents

# Shape of a parseable date, its format, and a whole number.
DATE_SHAPE = r"^[A-Za-z]{3} \d{1,2}, \d{4}$"
DATE_FORMAT = "MMM d, yyyy"
WHOLE_NUMBER = r"^\d+$"

# Fixed value: the document's own id field, which is also the name of the extracted column.
DOCUMENT_ID = "steam_appid"


def unwrap_details(details: DataFrame) -> DataFrame:
    """(app_id, success, data) from envelopes that are keyed by the id as text.

    A missing key, or an entry that does not report success, has no data. A document that cannot
    be parsed stops the step: it must not pass as an answer without success. The envelope is
    unfolded by a generator, so that a filter on `success` cannot make it be parsed again.
    """
    envelope = F.from_json(
        "envelope",
        T.MapType(T.StringType(), T.StructType.fromDDL("success boolean, data variant")),
        {"mode": "FAILFAST"},
    )
    entry = F.try_element_at(envelope, F.col("app_id").cast("string"))
    opened = details.select("app_id", F.explode(F.array(entry)).alias("entry"))
    ok = F.coalesce(F.col("entry.success"), F.lit(False)) & F.col("entry.data").isNotNull()
    return opened.select(
        "app_id", ok.alias("success"), F.when(ok, F.col("entry.data")).alias("data")
    )


def extract_metadata(metadata: DataFrame) -> DataFrame:
    """One typed column per field in use; `data` is a variant, or JSON text.

    Absent is NULL, except that no achievements block means none. An unreleased entity, or one
    that does not say whether it is, has no release date. A value of the wrong type is NULL.
    """
    is_text = isinstance(metadata.schema["data"].dataType, T.StringType)
    doc = metadata.select(
        "app_id", (F.parse_json("data") if is_text else F.col("data")).alias("doc")
    )
    released = ~value_at("doc", "$.release_date.coming_soon", "boolean")
    date_text = text_at("doc", "$.release_date.date")
    age = text_at("doc", "$.required_age")
    return doc.select(
        "app_id",
        value_at("doc", f"$.{DOCUMENT_ID}", "bigint").alias(DOCUMENT_ID),
        text_at("doc", "$.name").alias("app_name"),
        text_at("doc", "$.type").alias("app_type"),
        text_at("doc", "$.short_description").alias("app_description"),
        F.when(
            released & date_text.rlike(DATE_SHAPE), F.try_to_date(date_text, DATE_FORMAT)
        ).alias("release_date"),
        texts_in("doc", "$.genres", "description").alias("genre_names"),
        F.when(age.rlike(WHOLE_NUMBER), age.try_cast("int")).alias("required_age"),
        value_at("doc", "$.is_free", "boolean").alias("is_free"),
        value_at("doc", "$.platforms.windows", "boolean").alias("is_windows"),
        value_at("doc", "$.platforms.mac", "boolean").alias("is_mac"),
        value_at("doc", "$.platforms.linux", "boolean").alias("is_linux"),
        value_at("doc", "$.metacritic.score", "int").alias("metacritic_score"),
        F.coalesce(value_at("doc", "$.achievements.total", "int"), F.lit(0)).alias(
            "achievement_count"
        ),
        value_at("doc", "$.recommendations.total", "int").alias("recommendation_count"),
        text_at("doc", "$.price_overview.currency").alias("price_currency"),
        cents(text_at("doc", "$.price_overview.initial")).alias("price_initial_usd"),
        cents(text_at("doc", "$.price_overview.final")).alias("price_final_usd"),
    )
