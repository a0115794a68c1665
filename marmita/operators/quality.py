"""Named rules applied to a table: warn, drop, fail, quarantine, count.

A rule that evaluates to null counts as failed.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str | Column]


def passes(predicate: str | Column) -> Column:
    return F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))


def passes_all(rules: Rules) -> Column:
    return reduce(and_, (passes(p) for p in rules.values()), F.lit(True))


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Drop mode: rows for which every rule holds."""
    return df.filter(passes_all(rules))


def failed_rules(rules: Rules) -> Column:
    """Names of the rules a row breaks, in rule order."""
    names = F.array(*(F.when(~passes(p), F.lit(name)) for name, p in rules.items()))
    return F.array_compact(names)


def with_failed_rules(df: DataFrame, rules: Rules) -> DataFrame:
    return df.withColumn("failed_rules", failed_rules(rules))


def quarantine(df: DataFrame, rules: Rules) -> DataFrame:
    """The complement of :func:`keep_valid`, each row with the rules it breaks."""
    return with_failed_rules(df.filter(~passes_all(rules)), rules)


def _counters(rules: Rules) -> list[Column]:
    counters = [F.count(F.lit(1)).alias("rows")]
    for name, predicate in rules.items():
        counters.append(F.count_if(passes(predicate)).alias(name))
    counters.append(F.count_if(passes_all(rules)).alias("rows_kept"))
    return counters


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows passed and failed per rule, in one pass over ``df``."""
    counted = df.agg(*_counters(rules))
    per_rule = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("passed")) for name in rules
    )))
    return counted.select("rows", per_rule.alias("r")).select(
        "r.rule", "r.passed", (F.col("rows") - F.col("r.passed")).alias("failed")
    )


def warn(df: DataFrame, rules: Rules, observe_as: str | Observation) -> DataFrame:
    """Warn mode: every row stays; counts ride along with the job that reads them.

    Batch callers pass an ``Observation``; in a stream a name puts the counts
    into each progress report.
    """
    return df.observe(observe_as, *_counters(rules))


def fail_on_violation(df: DataFrame, rules: Rules) -> DataFrame:
    """Fail mode: reading a row that breaks a rule ends the job with its rule names."""
    message = F.concat(F.lit("rules broken: "), F.array_join(failed_rules(rules), ", "))
    checked = F.when(passes_all(rules), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.filter(checked)
