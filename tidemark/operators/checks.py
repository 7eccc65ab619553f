"""Data-quality checks. Each returns the violating rows, so an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.registry import evidence_runs
from tidemark.schemas import HOUR_STATUSES


class Check(NamedTuple):
    """Violating rows under a name. Checks of the three common kinds also say what they look at,
    so that many of them can be counted in one pass: a predicate on single rows of a table, a key
    of it that must not repeat, or a column whose values a parent's column must hold."""

    name: str
    violations: DataFrame
    severity: str = "error"
    rule: tuple[DataFrame, str] | None = None
    key: tuple[DataFrame, tuple[str, ...]] | None = None
    reference: tuple[DataFrame, str, DataFrame, str] | None = None


def row_check(name: str, table: DataFrame, predicate: str, severity: str = "error") -> Check:
    """A check that looks at one row at a time; the predicate is true on a violation."""
    return Check(name, table.filter(predicate), severity, rule=(table, predicate))


def key_check(name: str, table: DataFrame, *key: str) -> Check:
    """No key may occur twice."""
    return Check(name, duplicates(table, *key), key=(table, key))


def reference_check(
    name: str, child: DataFrame, column: str, parent: DataFrame, key: str
) -> Check:
    """Every value of the child's column is in the parent's."""
    return Check(
        name, orphans(child, column, parent, key), reference=(child, column, parent, key)
    )


# ---- families ----


def is_null(column: str) -> str:
    return f"`{column}` is null"


def is_unaccepted(column: str, values: Sequence[str]) -> str:
    """The value is outside the list; NULL passes."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"`{column}` not in ({listed})"


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, for one column or several. NULL is not a key."""
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    return df.filter(present).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null reference has no parent.

    Distinct references are matched, not rows, so a reference shared by most rows is one row.
    """
    references = child.select(column).filter(F.col(column).isNotNull()).distinct()
    unknown = references.join(parent.select(F.col(key).alias(column)), column, "left_anti")
    return child.join(unknown, column, "left_semi")


def stale(table: DataFrame, column: str, as_of: datetime, hours: int) -> DataFrame:
    """One row with the newest load when it is older than `hours`, or when there is none."""
    newest = table.agg(F.max(column).alias("newest"))
    age = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("newest")
    return newest.filter(F.col("newest").isNull() | (age > hours * 3_600_000_000))


# ---- row contracts: fixed rules, as named SQL predicates that are true on a violation ----

# Both measures exist exactly on the days that were observed.
DAILY_CONTRACT = {
    "hours_out_of_range": "observed_hours not between 0 and 24",
    "mean_and_hours_disagree": "(avg_player_count is null) <> (observed_hours = 0)",
    "peak_and_hours_disagree": "(peak_player_count is null) <> (observed_hours = 0)",
    "peak_below_mean": "peak_player_count < avg_player_count",
}

# A rate exists exactly where there is a change and something to divide it by.
TRENDS_CONTRACT = {
    "change_is_not_the_difference": "avg_player_count_change is distinct from "
    "cast(avg_player_count - avg_player_count_prev_day as decimal(18, 1))",
    "rate_and_basis_disagree": "(avg_player_count_change_rate is null) <> "
    "(avg_player_count is null or avg_player_count_prev_day is null "
    "or avg_player_count_prev_day = 0)",
    "support_out_of_range": "observed_days_7d not between 0 and 7",
    "mean_and_support_disagree": "(avg_player_count_7d is null) <> (observed_days_7d = 0)",
    "peak_above_record": "peak_player_count > peak_player_count_record",
    "record_in_the_future": "last_record_day > date_day",
    "negative_days_since_peak": "days_since_peak < 0",
}

LEDGER_CONTRACT = {
    "unknown_status": is_unaccepted("status", HOUR_STATUSES),
    "complete_without_rows": "status = 'complete' and not has_observations",
    "unrecorded_with_rows": "status = 'unrecorded' and has_observations",
    "unaudited_with_run": "status = 'unaudited' and run_id is not null",
    "high_water_not_complete": "status <> 'complete' and is_high_water_mark",
}

BOARD_CONTRACT = {
    "current_above_day_peak": "current_player_count > peak_player_count_current_day",
    "day_peak_above_record": "peak_player_count_current_day > peak_player_count_record",
    "hours_out_of_range": "observed_hours_current_day not between 1 and 24",
}

NON_NEGATIVE = {"negative_count": "player_count < 0"}

SAME_ID = {"answered_for_another_id": "app_id <> steam_appid"}


def any_of(contract: Mapping[str, str]) -> str:
    return " or ".join(f"({rule})" for rule in contract.values())


def breaches(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Rows that break any predicate of a contract."""
    return df.filter(any_of(contract))


def tally(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Number of violations of every predicate, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in contract.items()])
    return counts.unpivot([], list(contract), "check", "violations")


# ---- whole-table checks ----


def ledger_not_dense(ledger: DataFrame) -> DataFrame:
    """One row when hours are missing or repeated, or when not exactly one is the mark."""
    hour = F.unix_timestamp("logical_hour")
    span = F.call_function("div", F.max(hour) - F.min(hour), F.lit(3600)) + 1
    return ledger.agg(
        F.count(F.lit(1)).alias("actual_rows"),
        span.alias("expected_rows"),
        F.count_if("is_high_water_mark").alias("flagged_rows"),
    ).filter("not (actual_rows <=> expected_rows) or flagged_rows <> 1")


def recently_short(ledger: DataFrame, as_of: datetime | Column, hours: int = 24) -> DataFrame:
    """Hours that ran short within the `hours` before `as_of`: a warning while it can be looked
    into, where the ledger keeps the hour for good."""
    end = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    since = end - F.make_dt_interval(hours=F.lit(hours))
    recent = (F.col("logical_hour") > since) & (F.col("logical_hour") <= end)
    return ledger.filter((F.col("status") == "ran_short") & recent).select(
        "logical_hour", "status", "failed_count", "loaded_count"
    )


def unrecorded_days(days: DataFrame) -> DataFrame:
    """Days of `ledger.catalog_days` without a record."""
    return days.filter("not is_recorded").select("date_day")


def ranks_with_holes(board: DataFrame) -> DataFrame:
    """One row per rank column whose highest rank is not its number of distinct ranks.

    Each rank is folded to one row before it is counted.
    """

    def holes(column: str) -> DataFrame:
        folded = board.select(column).distinct()
        return folded.agg(
            F.max(column).alias("max_rank"), F.count(column).alias("distinct_ranks")
        ).select(F.lit(column).alias("rank_column"), "max_rank", "distinct_ranks")

    both = holes("current_rank").unionByName(holes("rank_7d"))
    return both.filter("max_rank <> distinct_ranks")


def unflagged_unobservable(
    runs: DataFrame, unobservable: DataFrame, dim: DataFrame
) -> DataFrame:
    """Entities of the latest evidence run that the dimension does not flag, or does not know."""
    latest = unobservable.join(evidence_runs(runs, 1).select("run_id"), "run_id").select("app_id")
    flags = dim.select("app_id", "is_unobservable")
    return (
        latest.join(flags, "app_id", "left")
        .filter(~F.coalesce("is_unobservable", F.lit(False)))
        .select("app_id")
    )


def summarize(checks: Iterable[Check]) -> DataFrame:
    """(check, severity, violations) for a list of checks.

    Rows of a table are looked at once for all its rules. Keys of all tables are counted in one
    aggregate, and references to one parent are folded and matched together. Checks that ask the
    same of the same table are counted once.
    """
    rules: dict[int, list[Check]] = {}
    keys: dict[tuple, list[Check]] = {}
    parents: dict[tuple, dict[tuple, list[Check]]] = {}
    counted: list[DataFrame] = []
    for check in checks:
        if check.rule:
            rules.setdefault(id(check.rule[0]), []).append(check)
        elif check.key and _has_common_shape(*check.key):
            table, key = check.key
            keys.setdefault((id(table), key), []).append(check)
        elif check.reference:
            child, column, parent, key = check.reference
            asked = parents.setdefault((id(parent), key), {})
            asked.setdefault((id(child), column), []).append(check)
        else:
            counted.append(check.violations.agg(_line(check, F.count(F.lit(1))).alias("l")))
    for group in rules.values():
        table = group[0].rule[0]
        lines = [_line(check, F.count_if(F.expr(check.rule[1]))) for check in group]
        counted.append(table.agg(F.array(*lines).alias("ls")).select(F.explode("ls").alias("l")))
    if keys:
        counted.append(_named(list(keys.values()), _repeated(list(keys.values()))))
    for asked in parents.values():
        counted.append(_named(list(asked.values()), _unknown(list(asked.values()))))
    return reduce(DataFrame.unionByName, counted).select("l.*")


def _line(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.severity).alias("severity"),
        violations.alias("violations"),
    )


def _named(groups: list[list[Check]], counts: DataFrame) -> DataFrame:
    """Lines of all checks from (number, violations) of the groups that have any; one row of
    numbers stands for all, so a group without violations has its line too."""
    found = counts.agg(F.map_from_entries(F.collect_list(F.struct("number", "violations"))).alias("m"))
    lines = [
        _line(check, F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0).cast("bigint")))
        for k, group in enumerate(groups)
        for check in group
    ]
    return found.select(F.explode(F.array(*lines)).alias("l"))


NUMBERS = ("tinyint", "smallint", "int", "bigint", "date", "timestamp")


def _has_common_shape(table: DataFrame, key: tuple[str, ...]) -> bool:
    """Up to two numbers and two texts; other keys are counted each for themselves."""
    kinds = [dict(table.dtypes)[c] for c in key]
    texts = kinds.count("string")
    return texts <= 2 and len(kinds) - texts <= 2 and set(kinds) <= {*NUMBERS, "string"}


def _repeated(groups: list[list[Check]]) -> DataFrame:
    """(number, violations): keys that occur more than once, all tables in one aggregate.

    Keys are brought to one shape: whole numbers, times and days as numbers, texts as they are.
    """
    rows = []
    for k, group in enumerate(groups):
        table, key = group[0].key
        present = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
        kinds = dict(table.dtypes)
        numbers = [_as_number(c, kinds[c]) for c in key if kinds[c] != "string"]
        texts = [F.col(c) for c in key if kinds[c] == "string"]
        numbers += [F.lit(None).cast("bigint")] * (2 - len(numbers))
        texts += [F.lit(None).cast("string")] * (2 - len(texts))
        shape = [x.alias(n) for x, n in zip([*numbers, *texts], ("i", "j", "s", "t"))]
        rows.append(table.filter(present).select(F.lit(k).alias("number"), *shape))
    seen = reduce(DataFrame.unionAll, rows).groupBy("number", "i", "j", "s", "t").count()
    return seen.filter("count > 1").groupBy("number").agg(F.count(F.lit(1)).alias("violations"))


def _as_number(column: str, kind: str) -> Column:
    if kind == "timestamp":
        return F.unix_micros(column)
    return F.unix_date(column).cast("bigint") if kind == "date" else F.col(column).cast("bigint")


def _unknown(groups: list[list[Check]]) -> DataFrame:
    """(number, violations): rows whose reference one parent lacks, references folded first."""
    _, _, parent, key = groups[0][0].reference
    rows = [
        group[0].reference[0].select(
            F.lit(k).alias("number"), F.col(group[0].reference[1]).alias("reference")
        )
        for k, group in enumerate(groups)
    ]
    folded = reduce(DataFrame.unionAll, rows).filter("reference is not null")
    folded = folded.groupBy("number", "reference").agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(key).alias("reference"))
    lost = folded.join(known, "reference", "left_anti")
    return lost.groupBy("number").agg(F.sum("n").alias("violations"))
