"""Validation rules as SQL predicates, and the columns that record failures.

A rule is a SQL predicate that is true for a *bad* row. A predicate that
evaluates to NULL does not flag the row (three-valued logic), so rules that
must also catch NULL say so themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_PREFIX = "err_"
ERRORS = "validation_errors"
VALID = "is_valid"


def _quoted(name: str) -> str:
    return f"`{name}`"


def missing(column: str) -> str:
    return f"{_quoted(column)} IS NULL"


def missing_or_not_positive(column: str) -> str:
    return f"({missing(column)}) OR ({_quoted(column)} <= 0)"


def missing_or_negative(column: str) -> str:
    return f"({missing(column)}) OR ({_quoted(column)} < 0)"


def outside(column: str, allowed: Iterable[str]) -> str:
    """Flags values outside ``allowed``; NULL is not flagged."""
    values = ", ".join("'" + value.replace("'", "\\'") + "'" for value in allowed)
    return f"{_quoted(column)} NOT IN ({values})"


def missing_or_unlike(column: str, pattern: str) -> str:
    return f"({missing(column)}) OR ({_quoted(column)} NOT LIKE '{pattern}')"


def error_column(rule: str) -> str:
    return ERROR_PREFIX + rule


def rule_flags(rules: Mapping[str, str]) -> dict[str, Column]:
    """One ``err_<rule>`` column per rule: the rule's name, or NULL."""
    return {
        error_column(rule): F.when(F.expr(predicate), F.lit(rule))
        for rule, predicate in rules.items()
    }


def error_list(rules: Mapping[str, str]) -> Column:
    """Array of the names of the failed rules.

    Built by concatenating zero- or one-element arrays rather than with a
    lambda filter: lambdas cannot take part in whole-stage code generation.
    """
    none = F.array().cast("array<string>")
    parts = [
        F.when(F.expr(predicate), F.array(F.lit(rule))).otherwise(none)
        for rule, predicate in rules.items()
    ]
    return F.concat(*parts) if parts else none


def any_failure(rules: Mapping[str, str]) -> Column:
    """True when at least one rule flags the row, never NULL."""
    flagged = F.lit(False)
    for predicate in rules.values():
        flagged = flagged | F.coalesce(F.expr(predicate), F.lit(False))
    return flagged


def tag_failures(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Adds ``err_*``, ``validation_errors`` and ``is_valid`` in one projection."""
    flags = [column.alias(name) for name, column in rule_flags(rules).items()]
    return df.select(
        "*", *flags, error_list(rules).alias(ERRORS), (~any_failure(rules)).alias(VALID)
    )
