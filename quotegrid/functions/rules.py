"""Ordered text rules compiled to native column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Gives ``label`` to texts that meet every stated condition."""

    label: str
    prefixes: tuple[str, ...] = ()
    any_of: tuple[str, ...] = ()
    all_of: tuple[str, ...] = ()


def any_prefix(col: Column, prefixes: Iterable[str]) -> Column:
    """True where the text starts with one of ``prefixes`` (pushed to the parquet scan)."""
    return reduce(or_, [col.startswith(p) for p in prefixes], F.lit(False))


def any_substring(col: Column, words: Iterable[str], ignore_case: bool = True) -> Column:
    """True where the text contains one of ``words``."""
    if ignore_case:
        col, words = F.lower(col), [w.lower() for w in words]
    return reduce(or_, [col.contains(w) for w in words], F.lit(False))


def _matches(col: Column, rule: Rule) -> Column:
    tests = []
    if rule.prefixes:
        tests.append(any_prefix(col, rule.prefixes))
    if rule.any_of:
        tests.append(any_substring(col, rule.any_of, ignore_case=False))
    tests.extend(col.contains(w) for w in rule.all_of)
    return reduce(and_, tests)


def classify(
    col: Column, rules: Sequence[Rule], default: str, ignore_case: bool = False
) -> Column:
    """Label of the first matching rule, else ``default`` (also for null texts)."""
    text = F.lower(col) if ignore_case else col
    label = None
    for rule in rules:
        hit = _matches(text, rule)
        label = F.when(hit, rule.label) if label is None else label.when(hit, rule.label)
    return F.lit(default) if label is None else label.otherwise(default)
