"""Checks of the facts, kept by day: a check run costs the days that were refreshed.

A fact's violations belong to days: rows lie in one day, a repeated key lies in one day, and a
reference without a parent is found in the rows of a day. What each day has is kept as a small
table of violations, days without any leaving no row. After a refresh the rows of its days are
replaced and all others stand, so history is not read again. The other tables of the model are
small and checked whole.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks as ck
from tidemark.plans.model import Model, Raw, model_checks
from tidemark.sources.versions import Store

STATES = "check_states"
FACTS = ("fct_player_counts", "fct_player_counts_daily", "fct_player_trends_daily")
COLUMNS = "date_day date, check string, reference string, violations bigint"


def split(found: Iterable[ck.Check]) -> tuple[list[ck.Check], list[ck.Check]]:
    """Checks of the facts, and all others."""
    found = list(found)
    of_facts = [c for c in found if c.name.split(".")[0] in FACTS]
    return of_facts, [c for c in found if c not in of_facts]


def _touched(days: Collection[date] | None) -> Column:
    """Rows of some days; those without a day have no folder of their own and always count."""
    if days is None:
        return F.lit(True)
    day = F.col("date_day")
    return day.isNull() | (day.isin(*days) if days else F.lit(False))


def day_states(found: list[ck.Check], days: Collection[date] | None = None) -> DataFrame:
    """(date_day, check, reference, violations) of checks on tables in folders by `date_day`.

    Rows only where there are violations: of a rule or a key one per day and check, of a
    reference one per day and value that the parent lacks. Only the folders of `days` are read.
    """
    rules: dict[int, list[ck.Check]] = {}
    rows: list[DataFrame] = []
    for check in found:
        if check.rule:
            rules.setdefault(id(check.rule[0]), []).append(check)
        elif check.key:
            table, key = check.key
            within = [*dict.fromkeys(["date_day", *key])]
            present = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
            seen = table.filter(_touched(days)).filter(present).groupBy(*within).count()
            counts = seen.filter("count > 1").groupBy("date_day").agg(
                F.count(F.lit(1)).alias("violations")
            )
            rows.append(_rows(counts, F.lit(check.name), F.lit(None).cast("string")))
        else:
            child, column, parent, key = check.reference
            folded = (
                child.filter(_touched(days) & F.col(column).isNotNull())
                .groupBy("date_day", F.col(column).alias("value"))
                .agg(F.count(F.lit(1)).alias("violations"))
            )
            lost = folded.join(parent.select(F.col(key).alias("value")), "value", "left_anti")
            rows.append(_rows(lost, F.lit(check.name), F.col("value").cast("string")))
    for group in rules.values():
        table = group[0].rule[0]
        counts = [F.count_if(F.expr(c.rule[1])).alias(c.name.replace(".", "-")) for c in group]
        by_day = table.filter(_touched(days)).groupBy("date_day").agg(*counts)
        lines = [
            F.struct(F.lit(c.name).alias("check"), F.col(c.name.replace(".", "-")).alias("violations"))
            for c in group
        ]
        each = by_day.select("date_day", F.inline(F.array(*lines))).filter("violations > 0")
        rows.append(_rows(each, F.col("check"), F.lit(None).cast("string")))
    return reduce(DataFrame.unionByName, rows)


def _rows(counts: DataFrame, check: Column, reference: Column) -> DataFrame:
    return counts.select(
        "date_day", check.alias("check"), reference.alias("reference"), "violations"
    )


def refresh_states(
    store: Store, found: list[ck.Check], days: Collection[date] | None = None
) -> DataFrame:
    """Bring the kept states up to date after a refresh of `days` and publish them; of all days if
    there are none yet or without `days`."""
    held = STATES in store.current()[1]
    states = day_states(found, days if held else None)
    if held and days is not None:
        kept = store.read(STATES).filter(~_touched(days))
        states = kept.select(*states.columns).unionByName(states)
    build = store.build()
    states = build.write(STATES, states.coalesce(1))
    build.publish()
    return states


def summarize_states(found: list[ck.Check], states: DataFrame) -> DataFrame:
    """(check, severity, violations) of the facts' checks from their states.

    References that had no parent are matched again, as a parent may have come since. A parent
    never goes: the registry and the calendar only grow.
    """
    spark = states.sparkSession
    known = [
        parent.select(F.lit(check.name).alias("check"), F.col(key).cast("string").alias("reference"))
        for check in found
        if check.reference
        for _, _, parent, key in [check.reference]
    ]
    asked = states.filter("reference is not null").select("check", "reference").distinct()
    still = reduce(
        DataFrame.unionByName,
        [asked.join(k, ["check", "reference"], "left_semi") for k in known],
    ) if known else asked.limit(0)
    open_ = states.join(still, ["check", "reference"], "left_anti")
    summed = open_.groupBy("check").agg(F.sum("violations").alias("violations"))
    lines = spark.createDataFrame([(c.name, c.severity) for c in found], "check string, severity string")
    return lines.join(summed, "check", "left").select(
        "check", "severity", F.coalesce("violations", F.lit(0).cast("bigint")).alias("violations")
    )


def incremental_checks(
    model: Model, raw: Raw, as_of: datetime, store: Store, days: Collection[date] | None = None
) -> DataFrame:
    """`summarize(model_checks(...))` after a refresh of `days`, reading only those of the facts.

    `model` is the model as it is now, on the facts as the store has them.
    """
    of_facts, others = split(model_checks(model, raw, as_of))
    states = refresh_states(store, of_facts, days)
    return ck.summarize(others).unionByName(summarize_states(of_facts, states))
