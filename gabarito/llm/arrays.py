"""Scans over arrays as column expressions, with about n * sqrt(n) steps for n entries.

A lambda evaluates the columns it mentions once an entry, so what several entries need is bound
to a variable first. An array that grows within a fold is copied at every step; a scan therefore
goes over sqrt(n) parts of sqrt(n) entries.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is evaluated once."""
    return F.transform(F.array(value), use)[0]


def parts_of(values: Column) -> Column:
    """`values`, not empty and cheap to evaluate, in about as many parts as a part has entries."""
    width = F.ceil(F.sqrt(F.size(values))).cast("int")
    last = F.floor((F.size(values) - 1) / width).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(values, k * width + 1, width))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """`combine` of every entry of an int array with all before it, beginning with 0."""

    def scan(part: Column, begin: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            at = combine(state["at"], x)
            return F.struct(at.alias("at"), F.concat(state["done"], F.array(at)).alias("done"))

        return F.aggregate(part, F.struct(begin.alias("at"), F.array().cast("array<int>").alias("done")), step)["done"]

    def over(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda a, b: combine(a, b)))
        before = F.slice(F.concat(F.array(F.lit(0)), scan(totals, F.lit(0))), 1, F.size(parts))
        return F.flatten(F.zip_with(parts, before, scan))

    return bound(values, lambda v: F.when(F.size(v) == 0, v).otherwise(bound(parts_of(v), over)))


def merged(spans: Column) -> Column:
    """The union of spans given in any order, as sorted (start, end); touching spans are one."""

    def of_peaks(ordered: Column, peaks: Column) -> Column:
        before = F.transform(ordered, lambda s, i: F.struct(s["start"].alias("start"), F.get(peaks, i - 1).alias("reached")))
        fresh = F.filter(before, lambda s: s["reached"].isNull() | (s["start"] > s["reached"]))
        close = lambda f: F.transform(
            f, lambda s, i: F.struct(s["start"].alias("start"), F.coalesce(F.get(f, i + 1)["reached"], F.element_at(peaks, -1)).alias("end"))
        )
        return bound(fresh, close)

    plain = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    ends = lambda ordered: F.transform(ordered, lambda s: s["end"])
    return bound(plain, lambda o: bound(running(ends(o), F.greatest), lambda peaks: of_peaks(o, peaks)))
