"""Scalar functions of the reference as Spark column expressions.

Text: split on ``,`` or on whitespace, i-th / last field, first character and
the rest, composite ``a,b`` keys, empty test.  Math: absolute difference,
truncating integer division, double ratio, conditional pick.  Arrays: sort and
join, append, membership, argmin over a short literal list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(line: Column, i: int, sep: str = ",") -> Column:
    """0-based i-th field of a separated line (null when absent)."""
    return F.get(F.split(line, sep), i)


def last_field(line: Column, sep: str = ",") -> Column:
    return F.element_at(F.split(line, sep), -1)


def whitespace_fields(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def first_char(s: Column) -> Column:
    return F.substring(s, 1, 1)


def tail(s: Column) -> Column:
    """Everything after the first character."""
    return F.substr(s, F.lit(2))


def pair_key(a: Column, b: Column) -> Column:
    """Composite ``a,b`` string key."""
    return F.concat_ws(",", a.cast("string"), b.cast("string"))


def is_empty_flag(s: Column) -> Column:
    """1 when the string is empty, else 0 (an integer, portable across engines)."""
    return F.when(s == "", 1).otherwise(0)


def abs_diff(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def idiv(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (SQL ``div``, bigint result)."""
    return F.call_function("div", a, b)


def ratio(a: Column, b: Column) -> Column:
    """Double division."""
    return a.cast("double") / b.cast("double")


def pick_larger(a: Column, b: Column) -> Column:
    return F.when(a > b, a).otherwise(b)


def joined(values: Column, sep: str = ",") -> Column:
    """Join a numeric array as ``n1,n2,...`` text, keeping its order."""
    return F.array_join(values.cast("array<string>"), sep)


def sorted_join(values: Column, sep: str = ",") -> Column:
    """Sort numerically, then join as text (order is defined before the cast)."""
    return joined(F.sort_array(values), sep)


def append_value(values: Column, value) -> Column:
    return F.concat(values, F.array(F.lit(value).cast("bigint")))


def contains_value(values: Column, value) -> Column:
    return F.exists(values, lambda x: x == F.lit(value))


def nearest_value(v: Column, candidates: Sequence[int]) -> Column:
    """The candidate closest to the integer ``v``; ties go to the smallest candidate.

    ``candidates`` is a short literal list (K centroids): a chain of comparisons
    with the midpoints of neighbours, which stays inside whole-stage codegen.
    """
    cs = sorted({int(c) for c in candidates})
    lit = lambda c: F.lit(c).cast("bigint")
    if not cs:
        return lit(None)
    chain = F.when(v.isNull(), lit(None))
    for a, b in zip(cs, cs[1:]):
        chain = chain.when(v <= lit((a + b) // 2), lit(a))
    return chain.otherwise(lit(cs[-1]))
