"""Expressions over any number of k-mer tables, evaluated on one row for each k-mer: one shuffle, however many tables.

    a, b, c = Kmers("a"), Kmers("b", ci=2), Kmers("c")
    evaluate((a * b) + (c - a), {"a": table_a, "b": table_b, "c": table_c})

`*` is intersection, `+` union, `-` subtraction of k-mers and `^` subtraction of counters (Python binds `^` least); the methods
of the same meaning take a mode of kmers.MODES. Bounds ci and cx apply to a table's counters before anything else, and reach its scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .kmers import CX, MODES


class Expression:
    def intersect(self, other: Expression, mode: str = "min") -> Expression:
        return Pair(self, other, lambda a, b: _counter(a.isNotNull() & b.isNotNull(), a, b, mode))

    def union(self, other: Expression, mode: str = "sum") -> Expression:
        return Pair(self, other, lambda a, b: _counter(a.isNotNull() | b.isNotNull(), a, b, mode))

    def subtract(self, other: Expression) -> Expression:
        return Pair(self, other, lambda a, b: F.when(b.isNull(), a))

    def subtract_counts(self, other: Expression) -> Expression:
        return Pair(self, other, lambda a, b: _counter(a.isNotNull(), a, b, "diff"))

    __mul__, __add__, __sub__, __xor__ = intersect, union, subtract, subtract_counts

    def leaves(self) -> list[Kmers]:
        raise NotImplementedError

    def counter(self, of: Callable[[Column | Kmers], Column]) -> Column:
        """The counter of a k-mer, null where it has none. `of` gives that of a table, and keeps each step as a column."""
        raise NotImplementedError


@dataclass(frozen=True)
class Kmers(Expression):
    """The table of that name, with counters in ci..cx."""

    name: str
    ci: int = 1
    cx: int = CX

    def leaves(self) -> list[Kmers]:
        return [self]

    def counter(self, of: Callable[[Column | Kmers], Column]) -> Column:
        return of(self)


@dataclass(frozen=True)
class Pair(Expression):
    left: Expression
    right: Expression
    how: Callable[[Column, Column], Column]

    def leaves(self) -> list[Kmers]:
        return self.left.leaves() + self.right.leaves()

    def counter(self, of: Callable[[Column | Kmers], Column]) -> Column:
        return of(self.how(self.left.counter(of), self.right.counter(of)))


def _counter(there: Column, a: Column, b: Column, mode: str) -> Column:
    zero = F.lit(0).cast("long")
    value = MODES[mode](F.coalesce(a, zero), F.coalesce(b, zero))
    return F.when(there & (value > 0), value) if mode == "diff" else F.when(there, value)


def counters(tables: dict[str, DataFrame], wanted: list[Kmers]) -> DataFrame:
    """kmer and, for each name, its counter or null: a tagged union and one aggregate. Of a table only what some bound lets
    through is read."""
    parts = []
    for name in sorted({x.name for x in wanted}):
        bounds = [x for x in wanted if x.name == name]
        kept = tables[name].where(F.col("cnt").between(min(x.ci for x in bounds), max(x.cx for x in bounds)))
        parts.append(kept.select("kmer", F.lit(name).alias("of"), F.col("cnt").cast("long").alias("cnt")))
    each = [F.sum(F.when(F.col("of") == name, F.col("cnt"))).alias(f"cnt_{name}") for name in sorted({x.name for x in wanted})]
    return reduce(DataFrame.unionByName, parts).groupBy("kmer").agg(*each)


def evaluate(expression: Expression, tables: dict[str, DataFrame]) -> DataFrame:
    """(kmer, cnt) of an expression over tables (kmer, cnt; a k-mer stands once in each) by their names."""
    return evaluate_all({"": expression}, tables).drop("output")


def evaluate_all(expressions: dict[str, Expression], tables: dict[str, DataFrame]) -> DataFrame:
    """(output, kmer, cnt) of several expressions by name, all from one aggregate over the tables."""
    leaves = [x for e in expressions.values() for x in e.leaves()]
    if missing := sorted({x.name for x in leaves} - tables.keys()):
        raise ValueError(f"no table named {missing}")
    steps: list[Column] = []

    def of(x: Column | Kmers) -> Column:
        own = F.col(f"cnt_{x.name}") if isinstance(x, Kmers) else x
        steps.append(F.when(own.between(x.ci, x.cx), own) if isinstance(x, Kmers) else own)
        return F.col(f"step_{len(steps) - 1}")

    results = F.array(*(F.struct(F.lit(name).alias("output"), e.counter(of).alias("cnt")) for name, e in expressions.items()))
    rows = counters(tables, leaves)
    for i, step in enumerate(steps):
        rows = rows.withColumn(f"step_{i}", step)
    return rows.select("kmer", F.explode(results).alias("r")).where("r.cnt is not null").select("r.output", "kmer", "r.cnt")
