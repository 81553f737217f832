"""What a query from elsewhere may touch, judged by its analysed plan."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

#: Session setting that names the temporary views a query may read.
VIEWS = "blotter.views"
# Leaves that hold no data of anyone.
_PLAIN_LEAVES = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef"}


class ForbiddenQuery(ValueError):
    """A query that reads or calls something it may not."""


def _each(sequence) -> Iterator:
    return (sequence.apply(i) for i in range(sequence.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _calls_code(expression) -> bool:
    """Whether an expression calls a Java method by name or a function someone registered."""
    kind = _kind(expression)
    registered = kind.startswith(("Scala", "Python", "Hive")) and "UD" in kind or "Aggregator" in kind
    if kind == "CallMethodViaReflection" or registered:
        return True
    return any(_calls_code(child) for child in _each(expression.children()))


def check_query(df: DataFrame, views: set[str]) -> None:
    """Raise unless the query reads only these temporary views and calls built-in functions.

    Views are not looked into: what they hold is up to whoever made them.
    """
    waiting = [df._jdf.queryExecution().analyzed()]
    while waiting:
        node = waiting.pop()
        if _kind(node) == "View":
            name = node.desc().identifier()
            if not node.isTempView() or name.database().isDefined() or name.table() not in views:
                raise ForbiddenQuery(f"the query reads {name.table()}, which is not offered")
            continue
        if any(map(_calls_code, _each(node.expressions()))):
            raise ForbiddenQuery("the query calls a function that is not built in")
        below = [*_each(node.children()), *_each(node.subqueries())]
        if not below and _kind(node) not in _PLAIN_LEAVES:
            raise ForbiddenQuery(f"the query reads a {_kind(node)}, which is not offered")
        waiting += below
