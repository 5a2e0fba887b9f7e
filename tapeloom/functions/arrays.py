"""Folds over arrays that stay linear: a fold that appends to its state copies all of it at each step.

So arrays are taken in blocks: a step copies a block at most, and the blocks' results are joined once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks(xs: Column, size: int = BLOCK) -> Column:
    """The array cut into arrays of ``size`` elements, the last maybe smaller."""
    n = F.ceil(F.size(xs) / F.lit(size)).cast("int")
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.slice(xs, i * size + 1, F.lit(size)))


def running(xs: Column, op: Callable[[Column, Column], Column], neutral: int = 0) -> Column:
    """x1, op(x1, x2), op(op(x1, x2), x3), ... of an array of int. ``op`` must be associative."""

    def fold(block: Column) -> Column:
        return F.aggregate(block, F.array().cast("array<int>"), lambda acc, x: F.array_append(acc, op(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(neutral)), x).cast("int")))

    def joined(cut: Column) -> Column:
        ends = fold(F.transform(cut, lambda b: F.element_at(b, -1)))
        return bind(ends, lambda e: F.flatten(F.transform(cut, lambda b, i: F.when(i > 0, F.transform(b, lambda x: op(F.get(e, i - 1), x).cast("int"))).otherwise(b))))

    return bind(bind(xs, lambda v: F.transform(blocks(v), fold)), joined)


def scan(xs: Column, start: Column, state: str, given: str, step: Callable[[Column, Column], Column], size: int = BLOCK) -> Column:
    """What ``step`` gives for each element of ``xs`` in turn, as an array of ``given``.

    ``step`` takes the state, of type ``state``, and an element, and returns struct<state, given>; it may be any function.
    """
    inner = f"struct<state:{state},out:array<{given}>>"
    outer = f"struct<state:{state},out:array<array<{given}>>>"

    def one(acc: Column, x: Column) -> Column:
        return bind(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["given"]).alias("out")).cast(inner))

    def block(acc: Column, b: Column) -> Column:
        first = F.struct(acc["state"].alias("state"), F.array().alias("out")).cast(inner)
        return bind(F.aggregate(b, first, one), lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["out"]).alias("out")).cast(outer))

    begin = F.struct(start.alias("state"), F.array().alias("out")).cast(outer)
    return F.aggregate(bind(xs, lambda v: blocks(v, size)), begin, block, lambda acc: F.flatten(acc["out"]))
