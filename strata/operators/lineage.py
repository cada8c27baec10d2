"""Gold tables in the order of what they read.

The tables a gold text reads are taken from Spark's parsed plan of it (the text is
not analysed, so the tables need not exist yet): relations anywhere in it, in
subqueries and common table expressions too, without the names such expressions
define. A gold table that another gold text reads is built before it. Texts that
wait for each other are refused with the circle they form. Reading the table one
writes is no dependency.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession


class LineageError(ValueError):
    """Gold texts that depend on each other in a circle."""


def _items(seq) -> Iterable:
    iterator = seq.iterator()
    while iterator.hasNext():
        yield iterator.next()


def _walk(node, hidden: frozenset[str], found: dict[str, None]) -> None:
    kind = node.getClass().getSimpleName()
    if kind == "UnresolvedRelation":
        parts = list(_items(node.multipartIdentifier()))
        name = ".".join(parts).lower()
        if len(parts) > 1 or name not in hidden:
            found[name] = None
    inner = hidden
    if kind == "UnresolvedWith":
        for relation in _items(node.cteRelations()):
            alias = relation._1().lower()
            _walk(relation._2(), inner, found)
            inner = inner | {alias}
    for child in _items(node.children()):
        _walk(child, inner, found)
    for subquery in _items(node.subqueries()):
        _walk(subquery, inner, found)


def tables_read(spark: SparkSession, sql_text: str) -> list[str]:
    """Names of the tables a query reads, in lower case, as they are written in it."""
    from .gold import clean_sql

    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(clean_sql(sql_text))
    found: dict[str, None] = {}
    _walk(plan, frozenset(), found)
    return list(found)


def dependencies(spark: SparkSession, golds: Sequence) -> dict[str, list[str]]:
    """Gold table -> gold tables its text reads; ``golds`` have ``sql`` and ``params``."""
    targets = {g.params.table.lower() for g in golds}
    if len(targets) != len(golds):
        raise LineageError("two gold texts write one table")
    return {g.params.table.lower(): [t for t in tables_read(spark, g.sql)
                                     if t in targets and t != g.params.table.lower()]
            for g in golds}


def _circle(waiting: dict[str, list[str]]) -> list[str]:
    """A circle among tables that all wait for another of them."""
    path = [next(iter(waiting))]
    while True:
        following = next(t for t in waiting[path[-1]] if t in waiting)
        if following in path:
            return path[path.index(following):] + [following]
        path.append(following)


def in_order(spark: SparkSession, golds: Sequence) -> list:
    """``golds`` so that every table is built before the texts that read it.

    Among those that may be next, the order given is kept.
    """
    needs = dependencies(spark, golds)
    left, out, done = list(golds), [], set()
    while left:
        ready = next((g for g in left if done.issuperset(needs[g.params.table.lower()])), None)
        if ready is None:
            names = {g.params.table.lower(): needs[g.params.table.lower()] for g in left}
            raise LineageError("gold texts wait for each other: " + " -> ".join(
                _circle({t: [n for n in ns if n not in done] for t, ns in names.items()})))
        left.remove(ready)
        out.append(ready)
        done.add(ready.params.table.lower())
    return out
