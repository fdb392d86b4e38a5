"""Rule-driven yearly data marts (A1–A5, T4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusmart.functions.metrics import AGGREGATES, MART_KEYS, MARTS, RISK_RULES

Rule = tuple[str, str]


def agg_expr(column: str, fn: str, alias: str | None = None) -> Column:
    """One mart aggregate. NULLs are skipped, NaN propagates (N7); an all-NULL
    group gives NULL."""
    if fn not in AGGREGATES:
        raise ValueError(f"unknown aggregate {fn!r} for {column!r}; use one of {AGGREGATES}")
    functions = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}
    return functions[fn](F.col(column)).alias(alias or column)


def usable_rules(df: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules whose column exists; unknown aggregate names are an error."""
    for column, fn in rules:
        if fn not in AGGREGATES:
            raise ValueError(f"unknown aggregate {fn!r} for {column!r}")
    return [(c, fn) for c, fn in rules if c in df.columns]


def build_mart(df: DataFrame, rules: list[Rule] = RISK_RULES) -> DataFrame:
    """Group by whichever of year/country/region/city_name exist and apply the
    rules whose column is present (A1). Raises when no rule is usable."""
    rules = usable_rules(df, rules)
    if not rules:
        raise ValueError("no mart rule applies to the columns of this frame")
    keys = [k for k in MART_KEYS if k in df.columns]
    return df.groupBy(*keys).agg(*[agg_expr(c, fn) for c, fn in rules])


def build_marts(df: DataFrame, marts: dict[str, list[Rule]] = MARTS) -> dict[str, DataFrame]:
    """All marts from ONE aggregate over the union of their rules.

    Silver is scanned and shuffled once; every mart is a projection of the
    shared aggregate (the risk rules are a superset of the other two).
    """
    union: list[Rule] = []
    for rules in marts.values():
        for rule in usable_rules(df, rules):
            if rule not in union:
                union.append(rule)
    if not union:
        raise ValueError("no mart rule applies to the columns of this frame")
    keys = [k for k in MART_KEYS if k in df.columns]
    names = {rule: f"{rule[0]}__{rule[1]}" for rule in union}
    shared = df.groupBy(*keys).agg(*[agg_expr(c, fn, names[(c, fn)]) for c, fn in union])
    out = {}
    for mart, rules in marts.items():
        cols = [F.col(names[r]).alias(r[0]) for r in usable_rules(df, rules)]
        out[mart] = shared.select(*keys, *cols)
    return out


def project_mart(shared_mart: DataFrame, rules: list[Rule]) -> DataFrame:
    """A smaller mart as a projection of a wider one built with the same
    aggregates (e.g. tourism from a written risk mart)."""
    keys = [k for k in MART_KEYS if k in shared_mart.columns]
    return shared_mart.select(*keys, *[c for c, _ in rules if c in shared_mart.columns])
