"""A compiler for data-quality checks: any number of checks, one scan per table, one shuffle.

Checks are declared as values (:class:`Rule`, :class:`Unique`, :class:`Foreign`) and compiled
together. Each table is read once; every row gives its *entries*, (check space, key):

* a rule: one entry without key for a row that fails;
* a unique key: the key, unless a part of it is null;
* a foreign key: the child's key, and from the parent table every key of the parent.

All entries of all tables meet in one aggregate by (space, key), added up within each task
first, so a key that a third of all rows carry is one entry per task. From its counts follow
failures, duplicated keys and orphans: no joins, and nothing that a hot key could skew.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Rows of ``table`` for which ``fails`` is true (null passes)."""
    name: str
    table: str
    column: str
    fails: Column


@dataclass(frozen=True)
class Unique:
    """No key occurs twice; keys with a null part are left out."""
    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Foreign:
    """Every key of the child, nulls aside, occurs in the parent."""
    child: str
    column: str
    parent: str
    key: str


Check = Rule | Unique | Foreign


def _text(keys: Sequence[str]) -> Column:
    """One key as itself, several as a JSON array: different keys have different texts."""
    parts = [F.col(k).cast("string") for k in keys]
    return parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))


def _entry(space: int, key: Column, n: int = 1, child: int = -1) -> Column:
    return F.struct(F.lit(space).alias("space"), key.alias("key"), F.lit(n).cast("bigint").alias("n"), F.lit(child).alias("child"))


class Plan:
    """Checks compiled against tables; ``tables`` maps names to DataFrames."""

    def __init__(self, checks: Sequence[Check], tables: dict[str, DataFrame]):
        self.checks = list(checks)
        self.foreign = [c for c in self.checks if isinstance(c, Foreign)]
        # a space for every rule and unique key, and one for every parent key, which its children share
        self.space: dict = {}
        for c in self.checks:
            self.space.setdefault((c.parent, c.key) if isinstance(c, Foreign) else id(c), len(self.space))
        per_table: dict[str, list[Column]] = {}
        need: dict[str, set[str] | None] = {}
        add = lambda table, entry: per_table.setdefault(table, []).append(entry)
        for c in self.checks:
            if isinstance(c, Rule):
                add(c.table, F.when(c.fails, _entry(self.space[id(c)], F.lit(None).cast("string"))))
            elif isinstance(c, Unique):
                whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in c.keys])
                add(c.table, F.when(whole, _entry(self.space[id(c)], _text(c.keys))))
            else:
                add(c.child, F.when(F.col(c.column).isNotNull(), _entry(
                    self.space[c.parent, c.key], _text([c.column]), 1, self.foreign.index(c))))
        for parent, key in {(c.parent, c.key) for c in self.foreign}:
            add(parent, F.when(F.col(key).isNotNull(), _entry(self.space[parent, key], _text([key]), 0)))
        scans = [tables[t].select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")
                 for t, entries in per_table.items()]
        every = reduce(lambda a, b: a.unionByName(b), scans)
        kids = [F.sum(F.when(F.col("child") == i, F.col("n"))).alias(f"f{i}") for i in range(len(self.foreign))]
        parent = F.max(F.col("child") == -1).alias("parent")
        # (space, key, n, whether a parent has the key, rows of each child with it)
        self.counts = every.groupBy("space", "key").agg(F.sum("n").alias("n"), parent, *kids)

    def _named(self, rows: Sequence[tuple], columns: str, failures: DataFrame) -> DataFrame:
        """Failures by check number with the checks' names; checks without failures have 0."""
        names = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(columns.split(), row)]) for row in rows])
        zero = failures.sparkSession.range(len(rows)).select(F.col("id").cast("int").alias("check"), F.lit(0).cast("bigint").alias("failures"))
        total = failures.unionByName(zero).groupBy("check").agg(F.sum("failures").alias("failures"))
        return total.select(F.element_at(names, F.col("check") + 1).alias("c"), "failures").select("c.*", "failures")

    def report(self) -> DataFrame:
        """(check_name, model, column_name, failures), one row per check: failing rows of a rule,
        duplicated keys of a unique key, child rows without a parent of a foreign key."""
        rows, at_space, at_child, unique = [], {}, {}, []
        for i, c in enumerate(self.checks):
            if isinstance(c, Foreign):
                rows.append(("relationships", c.child, c.column))
                at_child[self.foreign.index(c)] = i
                continue
            at_space[self.space[id(c)]] = i
            rows.append((c.name, c.table, c.column) if isinstance(c, Rule) else ("unique", c.table, ",".join(c.keys)))
            if isinstance(c, Unique):
                unique.append(self.space[id(c)])
        n = F.when(F.col("space").isin(unique), (F.col("n") > 1).cast("bigint")).otherwise(F.col("n"))
        number = F.array(*[F.lit(at_space.get(s, -1)) for s in range(len(self.space))])
        found = F.array(F.struct(F.element_at(number, F.col("space") + 1).alias("check"), n.alias("failures")), *[
            F.struct(F.when(~F.col("parent"), F.lit(i)).otherwise(-1).alias("check"), F.col(f"f{k}").alias("failures"))
            for k, i in at_child.items()])
        failures = (self.counts.select(F.explode(found).alias("x")).select("x.*")
                    .filter((F.col("check") >= 0) & (F.col("failures") > 0)))
        return self._named(rows, "check_name model column_name", failures)

    def duplicates(self) -> DataFrame:
        """(model, column_name, key_value, occurrences) of every key that a unique check finds twice or more."""
        unique = {self.space[id(c)]: c for c in self.checks if isinstance(c, Unique)}
        names = F.array(*[F.struct(F.lit(unique[s].table if s in unique else None).cast("string").alias("model"),
                                   F.lit(",".join(unique[s].keys) if s in unique else None).cast("string").alias("column_name"))
                          for s in range(len(self.space))])
        several = [s for s, c in unique.items() if len(c.keys) > 1]
        shown = F.when(F.col("space").isin(several), F.array_join(F.from_json("key", "array<string>"), "|")).otherwise(F.col("key"))
        return (self.counts.filter(F.col("space").isin(list(unique)) & (F.col("n") > 1))
                .select(F.element_at(names, F.col("space") + 1).alias("c"), shown.alias("key_value"), F.col("n").alias("occurrences"))
                .select("c.*", "key_value", "occurrences"))

    def orphans(self) -> DataFrame:
        """(child_table, child_column, parent_table, parent_column, orphans), one row per foreign key."""
        rows = [(c.child, c.column, c.parent, c.key) for c in self.foreign]
        found = F.array(*[F.struct(F.lit(i).alias("check"), F.col(f"f{i}").alias("failures")) for i in range(len(rows))])
        lost = self.counts.filter(~F.col("parent")).select(F.explode(found).alias("x")).select("x.*").filter(F.col("failures") > 0)
        return self._named(rows, "child_table child_column parent_table parent_column", lost).withColumnRenamed("failures", "orphans")
