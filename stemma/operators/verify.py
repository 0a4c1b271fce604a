"""Set-based checks of a published table against recomputed values (V1-V4)."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F


def equal_values(a: Column, b: Column) -> Column:
    """Null, 0 and '' are one value; numbers by difference under 1e-9; else as text (V2)."""
    x, y = a.try_cast("double"), b.try_cast("double")
    nothing = lambda c, n: c.isNull() | (c.cast("string") == "") | (n == 0)
    return F.coalesce(
        (nothing(a, F.coalesce(x, F.lit(1.0))) & nothing(b, F.coalesce(y, F.lit(1.0))))
        | F.coalesce(F.abs(x - y) < 1e-9, F.lit(False))
        | F.coalesce(a.cast("string") == b.cast("string"), F.lit(False)),
        F.lit(False),
    )


def compare(published: DataFrame, expected: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, expected, actual, passed), one row for each key and field."""
    e = expected.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = published.select(key, *fields).join(e, key, "left")
    checks = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.col(f"_{f}").cast("string").alias("expected"), F.col(f).cast("string").alias("actual"), equal_values(F.col(f"_{f}"), F.col(f)).alias("passed"))
            for f in fields
        ]
    )
    return joined.select(key, F.inline(checks))


def pass_rates(checks: DataFrame) -> DataFrame:
    """(field, checked, passed, pass_rate_pct) (V3)."""
    return checks.groupBy("field").agg(
        F.count("*").alias("checked"), F.count_if("passed").alias("passed"), F.round(F.avg(F.col("passed").cast("double")) * 100, 2).alias("pass_rate_pct")
    )


def violations(table: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) in one pass: bounds, required columns and other row conditions that must hold (V4)."""
    counts = table.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counts.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, violations)")


def repeated_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that should be unique and are not (AG19)."""
    return table.groupBy(*keys).agg(F.count("*").alias("duplicate_count")).where("duplicate_count > 1")


def column_facts(table: DataFrame) -> DataFrame:
    """(column, kind, rows, filled) of every column, in one pass (V5)."""
    counts = table.agg(F.count("*").alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_{k}") for k, c in enumerate(table.columns)])
    facts = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("kind"), F.col("_rows").alias("rows"), F.col(f"_{k}").alias("filled")) for k, f in enumerate(table.schema)]
    return counts.select(F.inline(F.array(*facts)))


def export_checks(checks: DataFrame, folder: str) -> str:
    """Checks as CSV rows under ``folder/rows``, their pass rates as JSON under ``folder/fields``; the summary as text (SNK18)."""
    checks.write.mode("overwrite").option("header", True).csv(f"{folder}/rows")
    pass_rates(checks).coalesce(1).write.mode("overwrite").json(f"{folder}/fields")  # a row for each field
    rates = checks.sparkSession.read.json(f"{folder}/fields").orderBy("field").collect()
    asked, passed = sum(r.checked for r in rates), sum(r.passed for r in rates)
    return json.dumps({"checked": asked, "passed": passed, "fields": {r.field: r.pass_rate_pct for r in rates}}, ensure_ascii=False)


def phase_report(facts: dict[str, DataFrame], notes: dict[str, str]) -> str:
    """One-row tables of statistics and notes as JSON, decimals as numbers (SNK17)."""
    plain = lambda v: float(v) if isinstance(v, Decimal) else v.isoformat() if hasattr(v, "isoformat") else v
    rows = {name: next(iter(df.limit(1).collect()), None) for name, df in facts.items()}
    return json.dumps({"statistics": {n: {k: plain(v) for k, v in r.asDict().items()} if r else {} for n, r in rows.items()}, "notes": notes}, ensure_ascii=False)
