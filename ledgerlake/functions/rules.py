"""Turn rule lists (``insight_rules``) into column expressions."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGNS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq}


def holds(test: tuple) -> Column:
    """One test as a condition that is never null."""
    name, sign, value = test
    if sign == "missing":
        return F.col(name).isNull()
    met = F.col(name).isin(*value) if sign == "in" else _SIGNS[sign](F.col(name), F.lit(value))
    return F.coalesce(met, F.lit(False))


def all_hold(tests: list) -> Column:
    return reduce(operator.and_, map(holds, tests), F.lit(True))


def first_rule(rules: list, outcome=F.lit) -> Column:
    """``outcome`` of the first rule whose tests hold, null if none does."""
    return reduce(lambda rest, rule: F.when(all_hold(rule[1]), outcome(rule[0])).otherwise(rest), reversed(rules), F.lit(None))


def fill(template: str, values: dict[str, Column]) -> Column:
    """A template with its {names} replaced; null if one of them is null."""
    used = [n for n in values if "{" + n + "}" in template]
    return reduce(lambda text, n: F.replace(text, F.lit("{" + n + "}"), values[n]), used, F.lit(template))


def by_name(name: Column, table: dict[str, str], other: str, value) -> Column:
    """The value listed for a name, or the one for all others."""
    known = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), value(v))])
    return F.coalesce(F.element_at(known, name), value(other))
