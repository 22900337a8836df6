"""Declarative threshold rules → one ``CASE WHEN`` column (R-03 … R-11).

A rule is a tuple ``(column, op, value)``; a level fires when any of its
rules is TRUE.  NULL operands never fire on their own (three-valued logic of
``OR`` inside ``CASE``), which is what the original pipeline does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

_OPS = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "in": lambda c, v: c.isin(*v),
}

_SQL_OPS = {">": ">", ">=": ">=", "<": "<", "<=": "<=", "=": "=", "!=": "<>"}


def predicate(rule, col_map=None) -> Column:
    name, op, value = rule
    c = F.col((col_map or {}).get(name, name))
    return _OPS[op](c, value)


def any_of(rules, col_map=None) -> Column:
    return reduce(lambda a, b: a | b, [predicate(r, col_map) for r in rules])


def classify(critical, warning, col_map=None) -> Column:
    """First matching level wins: CRITICAL, then WARNING, else NOMINAL.

    Built from the rule table as one SQL expression (a single call to the
    JVM instead of one per comparison); :func:`classify_columns` is the same
    rule composed from Column objects."""
    return F.expr(classify_sql(critical, warning, col_map))


def classify_columns(critical, warning, col_map=None,
                     labels=(S.HEALTH_CRITICAL, S.HEALTH_WARNING, S.HEALTH_NOMINAL)) -> Column:
    return (F.when(any_of(critical, col_map), labels[0])
            .when(any_of(warning, col_map), labels[1])
            .otherwise(labels[2]))


def _sql_lit(v):
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def predicate_sql(rule, col_map=None) -> str:
    name, op, value = rule
    c = "`" + (col_map or {}).get(name, name) + "`"
    if op == "in":
        return f"{c} IN ({', '.join(_sql_lit(x) for x in value)})"
    return f"{c} {_SQL_OPS[op]} {_sql_lit(value)}"


def classify_sql(critical, warning, col_map=None) -> str:
    """The same rule as SQL text (used for oracle queries and SQL users)."""
    crit = " OR ".join(f"({predicate_sql(r, col_map)})" for r in critical)
    warn = " OR ".join(f"({predicate_sql(r, col_map)})" for r in warning)
    return (f"CASE WHEN {crit} THEN '{S.HEALTH_CRITICAL}' WHEN {warn} THEN '{S.HEALTH_WARNING}' "
            f"ELSE '{S.HEALTH_NOMINAL}' END")
