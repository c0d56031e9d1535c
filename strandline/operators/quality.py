"""Data-quality rules, the report they produce, the audit log and the gate."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import MARK, PROCESSED, SOURCES
from strandline.operators.increment import EPOCH, high_water_mark

ROW_COUNT = "Row Count Verification"
UNIQUE = "Unique Primary Key Grain"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL condition of a failing row; an unknown condition passes
    breach: str = "FAIL"  # or WARNING, which never stops the load


def _missing(column: str, name: str | None = None) -> Rule:
    return Rule(name or f"Required Column: {column}", f"{column} IS NULL")


def _blank(column: str, name: str | None = None) -> Rule:
    return Rule(
        name or f"Required Column: {column}", f"{column} IS NULL OR trim({column}) = ''"
    )


def _outside(name: str, column: str, low: int, high: int) -> Rule:
    return Rule(name, f"{column} < {low} OR {column} > {high}")


# Rule names and conditions as the audit log records them.
RULES: dict[str, tuple[Rule, ...]] = {
    "calendar": (
        _missing("Date"),
        _missing("year"),
        _missing("month"),
        _missing("quarter"),
        _missing("dayOfMonth"),
        _blank("DayName"),
        _missing("IsWeekend"),
        _outside("Logical Bounds: Valid Month (1-12)", "month", 1, 12),
        _outside("Logical Bounds: Valid Quarter (1-4)", "quarter", 1, 4),
        _outside("Logical Bounds: Valid Day (1-31)", "dayOfMonth", 1, 31),
    ),
    "customers": (
        _missing("CustomerKey", "Valid Primary Keys"),
        Rule("Email Format Check", "EmailAddress IS NULL OR EmailAddress NOT LIKE '%@%.%'"),
    ),
    "product_category": (
        _missing("ProductCategoryKey", "Mandatory Core Columns"),
        _blank("CategoryName", "Required String Columns"),
    ),
    "product_sub_category": (
        _missing("ProductSubcategoryKey"),
        _missing("ProductCategoryKey"),
        _blank("SubcategoryName"),
    ),
    "products": (
        _missing("ProductKey"),
        _missing("ProductSubcategoryKey"),
        _blank("ProductSKU"),
        _blank("ProductName"),
        Rule("Financial Logic: Non-Negative Values", "ProductPrice < 0 OR ProductCost < 0"),
        Rule(
            "Business Rule: Price Greater Than Cost", "ProductPrice < ProductCost", "WARNING"
        ),
    ),
    "returns": (
        _blank("ReturnKey"),
        _missing("ReturnDate"),
        _missing("TerritoryKey"),
        _missing("ProductKey"),
        Rule("Operational Rule: Quantity > 0", "ReturnQuantity <= 0"),
    ),
    "sales": (
        _missing("OrderNumber"),
        _missing("OrderLineItem"),
        _missing("ProductKey"),
        _missing("CustomerKey"),
        _missing("TerritoryKey"),
        _missing("OrderDate"),
        _missing("StockDate"),
        Rule("Logical Bounds: OrderQuantity > 0", "OrderQuantity <= 0"),
    ),
    "territories": (
        _missing("SalesTerritoryKey"),
        _blank("Region"),
        _blank("Country"),
        _blank("Continent"),
    ),
}

# What a row is told under besides the rules that it breaks: its mark, and its key.
_MARKED, _KEYED = -1, 0

# Columns of the audit log, those added later last. Files written before a column was there, or before
# counts were BIGINT, are read under these all the same.
AUDIT = (
    f"table_name STRING, rule_name STRING, status STRING, failed_rows BIGINT, {MARK} TIMESTAMP, "
    "evaluation_timestamp TIMESTAMP, checked_rows BIGINT"
)

ROW_COUNT_NAMES = {"customers": "Row Count Check"}


class QualityGateError(ValueError):
    """A Silver slice broke a rule that must hold before Gold is loaded."""


def count_duplicates(df: DataFrame, source: str) -> DataFrame:
    """One row: how many rows share their key with another row (every such row counts)."""
    per_key = df.groupBy(*SOURCES[source].keys).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0)).alias(
            "duplicate_rows"
        ),
    )


def quality_report(df: DataFrame, source: str) -> DataFrame:
    """One row per rule over a Silver slice; no rows for an empty slice.

    Row count, mark, duplicates and every condition come out of one scan. A row is told once under
    its key, and once without a key for every rule that it breaks. Counted map-side, the latter are one
    row per rule and task, so that the shuffle holds each key with one count and no counter of a rule.
    """
    rules, keys = RULES[source], SOURCES[source].keys
    broken = [F.when(F.expr(r.fails), F.lit(i)) for i, r in enumerate(rules, start=1)]
    told = df.select(*keys, PROCESSED, F.explode(F.array(F.lit(_MARKED), F.lit(_KEYED), *broken)).alias("_rule"))
    rule = F.col("_rule")
    counted = (
        told.filter(rule.isNotNull())
        .groupBy(
            "_rule", F.when(rule == _MARKED, F.col(PROCESSED)).alias("_mark"),
            *[F.when(rule == _KEYED, F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)],
        )
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    hits = lambda which: F.coalesce(F.sum(F.when(which, F.col("_n"))), F.lit(0))
    totals = counted.agg(
        hits(rule == _KEYED).alias("checked_rows"),
        F.max("_mark").alias(MARK),
        hits((rule == _KEYED) & (F.col("_n") > 1)).alias("_dup"),
        *[hits(rule == i).alias(f"_f{i}") for i in range(1, len(rules) + 1)],
    ).filter(F.col("checked_rows") > 0)

    lines = [
        (ROW_COUNT_NAMES.get(source, ROW_COUNT), "FAIL", F.lit(0).cast("bigint")),
        (UNIQUE, "FAIL", F.col("_dup")),
        *[(r.name, r.breach, F.col(f"_f{i}")) for i, r in enumerate(rules, start=1)],
    ]
    cells = [c for name, breach, n in lines for c in (F.lit(name), F.lit(breach), n)]
    long = totals.select(
        MARK, "checked_rows", F.stack(F.lit(len(lines)), *cells).alias("rule_name", "breach", "failed_rows")
    )
    return long.select(
        F.lit(source).alias("table_name"),
        "rule_name",
        F.when(F.col("failed_rows") == 0, "PASS").otherwise(F.col("breach")).alias("status"),
        "failed_rows",
        MARK,
        F.current_timestamp().alias("evaluation_timestamp"),
        "checked_rows",
    )


def verdict(report: DataFrame) -> DataFrame:
    """PASS or FAIL per table; warnings do not count."""
    failed = F.col("status") == "FAIL"
    return report.groupBy("table_name").agg(
        F.sum(F.when(failed, F.col("failed_rows")).otherwise(0)).alias("critical_failures"),
        F.when(F.count_if(failed) == 0, "PASS").otherwise("FAIL").alias("verdict"),
    )


def enforce(report: DataFrame) -> None:
    """Raise when a table's verdict is FAIL; one short row per table reaches the driver."""
    broken = verdict(report).filter(F.col("verdict") == "FAIL").collect()
    if broken:
        tables = ", ".join(f"{r.table_name} ({r.critical_failures} failures)" for r in broken)
        raise QualityGateError(f"Gold load stopped, quality rules failed: {tables}")


def append_audit(report: DataFrame, path: str) -> None:
    report.write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The whole log, its files' columns matched by name; rows written before a column existed read it as null."""
    return spark.read.schema(AUDIT).parquet(path)


def audited_mark(audit: DataFrame | None, advance_on_failure: bool = False) -> dt.datetime:
    """How far Silver has been validated.

    Slices with a failed rule are looked at again until they pass. With
    ``advance_on_failure`` any evaluated slice moves the mark.
    """
    if audit is None:
        return EPOCH
    if advance_on_failure:
        return high_water_mark(audit, MARK)
    slices = audit.groupBy("table_name", MARK, "evaluation_timestamp").agg(
        F.count_if(F.col("status") == "FAIL").alias("failed")
    )
    return high_water_mark(slices.filter(F.col("failed") == 0), MARK)
