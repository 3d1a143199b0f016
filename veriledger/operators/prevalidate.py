"""Checks on the rows as they are loaded: flag columns beside the base columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriledger.operators.conditions import Scope
from veriledger.operators.families import Rule
from veriledger.operators.ruleset import key_text


def add_flags(df: DataFrame, rules: Sequence[Rule], codes=None) -> DataFrame:
    """Append one boolean per rule, true where the row breaks it."""
    scope = Scope.of(df, codes)
    return df.withColumns({r.code: r.broken(scope) for r in rules})


def base_columns(flagged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The columns that go on to the table."""
    return flagged.drop(*[r.code for r in rules])


def shares(flagged: DataFrame, flags: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per rule: bad rows, all rows and the share of bad rows; one pass for all rules."""
    counts = flagged.groupBy(*by).agg(
        F.count("*").alias("n"), *[F.count_if(F.col(f)).alias(f) for f in flags]
    )
    rules = F.array(*[F.struct(F.lit(f).alias("rule"), F.col(f).alias("bad")) for f in flags])
    long = counts.select(*by, "n", F.inline(rules))
    return long.select(*by, "rule", "bad", "n", F.try_divide("bad", F.col("n").cast("double")).alias("share"))


def failures(flagged: DataFrame, flags: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Long form: one row per broken rule and row, with the source system if there is one."""
    names = F.array(*[F.when(F.col(f), F.lit(f)) for f in flags])
    any_flag = F.greatest(*[F.col(f) for f in flags]) if len(flags) > 1 else F.col(flags[0])
    source = F.col("src_stm") if "src_stm" in flagged.columns else F.lit(None).cast("string")
    return flagged.filter(any_flag).select(
        F.explode(names).alias("rule"), key_text(key).alias("key"), source.alias("src_stm")
    ).filter(F.col("rule").isNotNull())
