"""Data quality: rules, quarantine, reconciliation and run reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.joins import keys_of
from tidemill.schemas import STORE_RULES
from tidemill.session import stored


def check_table(
    df: DataFrame, table: str, filled: Sequence[str] = (), unique: Sequence[Sequence[str]] = ()
) -> DataFrame:
    """Failures of each rule: null values for ``filled``, repeated keys for ``unique``."""
    reports = []
    if filled:
        row = lambda c: F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit("not_null").alias("rule"),
            F.count_if(F.col(c).isNull()).alias("failures"),
        )
        reports.append(
            df.agg(F.array(*[row(c) for c in filled]).alias("r")).select(F.inline("r"))
        )
    for keys in unique:
        known = df.dropna(subset=list(keys))
        sizes = known.groupBy(*keys).agg(F.count("*").alias("_rows"))
        reports.append(sizes.agg(
            F.lit(table).alias("table_name"),
            F.lit(",".join(keys)).alias("column_name"),
            F.lit("unique").alias("rule"),
            F.count_if(F.col("_rows") > 1).alias("failures"),
        ))
    return reduce(DataFrame.unionByName, reports)


def check_store(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The report of all rules of the store tables, by name; see ``schemas.STORE_RULES``."""
    reports = [check_table(tables[name], name, filled, [unique]) for name, (filled, unique) in STORE_RULES.items()]
    return reduce(DataFrame.unionByName, reports)


def holds(rule: str | Column) -> Column:
    """Whether a rule holds; an unknown outcome counts as a failure."""
    test = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(test, F.lit(False))


def keep_expected(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Rows for which every rule holds."""
    return df.filter(reduce(lambda a, b: a & b, [holds(r) for r in rules.values()]))


def rule_failures(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """How many rows break each rule, in one pass."""
    rows = [
        F.struct(F.lit(name).alias("rule"), F.count_if(~holds(rule)).alias("failures"))
        for name, rule in rules.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def require_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, or an error if a key is null or repeated."""
    broken = check_table(df, "table", keys, [keys]).filter("failures > 0").take(len(keys) + 1)
    if broken:
        raise ValueError(f"not a primary key: {[(r.column_name, r.rule, r.failures) for r in broken]}")
    return df


def with_error(df: DataFrame, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    """Add the reason of the first check that applies as ``error``; null for good rows."""
    reason = F.lit(None).cast("string")
    for condition, label in reversed(list(checks)):
        reason = F.when(condition, F.lit(label)).otherwise(reason)
    return df.withColumn("error", reason)


def quarantine(
    df: DataFrame, id_column: str, checks: Sequence[tuple[Column, str]], store: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and ``(id, error)`` for the others; the input is evaluated once and stored.

    Without ``store`` both read it on their own, which is less work where it is a plain table.
    """
    marked = with_error(df, checks)
    marked = stored(marked, "checked") if store else marked
    good = marked.filter(F.col("error").isNull()).drop("error")
    bad = marked.filter(F.col("error").isNotNull()).select(
        F.col(id_column).cast("string").alias("id"), "error"
    )
    return good, bad


def error_tally(errors: DataFrame) -> DataFrame:
    """Errors by reason, with a ``total`` row."""
    counts = errors.groupBy("error").agg(F.count("*").alias("n"))
    return counts.unionByName(counts.agg(F.lit("total").alias("error"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of both sides and their difference, in one row."""
    loaded = target.select(F.count("*")).scalar()
    counted = source.agg(F.count("*").alias("source_rows")).withColumn("target_rows", loaded)
    return counted.withColumn("missing", F.col("source_rows") - F.col("target_rows"))


def run_report(marked: DataFrame) -> DataFrame:
    """Inputs, successes, failures and number of reasons of a frame with an ``error`` column."""
    counts = marked.groupBy("error").agg(F.count("*").alias("n"))
    failed = F.col("error").isNotNull()
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_ids"),
        F.coalesce(F.sum(F.when(~failed, F.col("n"))), F.lit(0)).alias("succeeded"),
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("failed"),
        F.count_if(failed).alias("reasons"),
    )


def retry_set(ids: DataFrame, loaded: DataFrame, errors: DataFrame, attempt: str) -> DataFrame:
    """Ids not loaded yet, each with the error of its last attempt."""
    waiting = ids.join(keys_of(loaded, ["id"]), "id", "left_anti")
    last = errors.groupBy("id").agg(F.max_by("error", attempt).alias("error"))
    return waiting.join(last, "id", "left")


def retry_rows(retries: DataFrame, loaded: DataFrame) -> DataFrame:
    """Ids to try again in the shape of the loaded table, all other columns null."""
    return retries.select(*[
        (F.col("id") if f.name == "id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in loaded.schema
    ])
