"""Schema-contract checks (C1–C6).  Each returns a DataFrame of violations;
an empty result means the contract holds.  ``violation_counts`` folds several
checks into one small report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators.loads import append_load, remove_path
from sluice.session import scratch_path


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or contain NULL (with their row count)."""
    keys = list(keys)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | any_null)
    )


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def foreign_key_violations(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows whose non-NULL key has no parent (NULL FK is allowed)."""
    cond = None
    for ck, pk in zip(child_keys, parent_keys):
        e = F.col(f"_c.{ck}") == F.col(f"_p.{pk}")
        cond = e if cond is None else cond & e
    not_null = F.lit(True)
    for ck in child_keys:
        not_null = not_null & F.col(ck).isNotNull()
    return (
        child.where(not_null)
        .alias("_c")
        .join(parent.select(*parent_keys).alias("_p"), cond, "left_anti")
    )


def closed_set_violations(df: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Non-NULL values outside the closed set."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))


def length_violations(df: DataFrame, column: str, max_len: int) -> DataFrame:
    """``VARCHAR(n)`` bound (characters)."""
    return df.where(F.char_length(F.col(column)) > max_len)


def not_null_rule(columns: Sequence[str]) -> Column:
    """C2 as a row predicate (true = violation)."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return cond


def closed_set_rule(column: str, allowed: Iterable[str]) -> Column:
    """C5 as a row predicate (true = violation)."""
    return F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))


def length_rule(column: str, max_len: int) -> Column:
    """C6 as a row predicate (true = violation)."""
    return F.char_length(F.col(column)) > max_len


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Row-level rules on one table counted in a single scan:
    ``(check_name, n_violations)`` per rule."""
    counts = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules.items()])
    return counts.select(
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("n_violations")) for name in rules
        ]))
    )


def violation_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check: ``(check_name, n_violations)``."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations")
        for name, df in checks.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enforcing_load(
    spark: SparkSession,
    df: DataFrame,
    table_path: str,
    quarantine_path: str,
    rules: dict[str, Column],
    keys: Sequence[str] = (),
    parents: dict[str, tuple[Sequence[str], DataFrame, Sequence[str]]] | None = None,
) -> dict[str, int]:
    """C1-C6 as a load: rows that hold every rule are appended to the table, all others
    to the quarantine with the names of the rules they break (``reasons``).

    ``rules`` are row predicates (true = broken); ``keys`` a primary key: all rows of a
    key that repeats, and rows with a NULL in it, break ``primary_key``; ``parents`` maps
    the name of a foreign key to (own columns, parent rows, parent columns).  The input is
    judged once, and written once with its verdict; counts of rows loaded, quarantined
    and broken by each rule come from that write.
    """
    broken = dict(rules)
    judged = df
    if keys:
        repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit(True).alias("_repeated")
        )
        judged = judged.join(repeated, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)], "left")
        broken["primary_key"] = F.col("_repeated") | not_null_rule(keys)
    for i, (name, (own, parent, other)) in enumerate((parents or {}).items()):
        held = parent.select(*[F.col(c).alias(f"_p{i}_{j}") for j, c in enumerate(other)]).distinct().withColumn(f"_held{i}", F.lit(True))
        judged = judged.join(held, [F.col(c) == F.col(f"_p{i}_{j}") for j, c in enumerate(own)], "left")
        broken[name] = F.col(f"_held{i}").isNull() & ~not_null_rule(own)
    reasons = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in broken.items()]))
    judged = judged.select(*df.columns, reasons.cast("array<string>").alias("reasons")).withColumn("_bad", F.size("reasons") > 0)
    seen = Observation()
    judged = judged.observe(
        seen,
        F.count_if(~F.col("_bad")).alias("loaded"),
        F.count_if("_bad").alias("quarantined"),
        *[F.count_if(F.array_contains("reasons", name)).alias(name) for name in broken],
    )
    staging = scratch_path(spark, "enforced")
    judged.write.partitionBy("_bad").parquet(staging)
    try:
        schema = judged.schema
        for bad, path, columns in ((False, table_path, df.columns), (True, quarantine_path, [*df.columns, "reasons"])):
            append_load(spark.read.schema(schema).parquet(staging).where(F.col("_bad") == bad).select(*columns), path)
    finally:
        remove_path(spark, staging)
    return dict(seen.get)
