"""Field mutations. Every function returns a step ``(df, when) -> df``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, field, let, nz, optional, put

DROP_MARK = "_marked_drop"


def remove(*names: str):
    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        if when is ALWAYS:
            return df.drop(*names)
        present = [n for n in names if n in df.columns]
        return put(df, {n: F.lit(None) for n in present}, when)

    return step


def mark(decision: str):
    """Mark rows ``drop`` or ``pass``; the last mark counts. See :func:`unmarked`."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        return put(df, {DROP_MARK: F.lit({"drop": True, "pass": False}[decision])}, when)

    return step


def unmarked(df: DataFrame) -> DataFrame:
    """Rows not marked for dropping."""
    if DROP_MARK not in df.columns:
        return df
    return df.filter(~F.coalesce(F.col(DROP_MARK), F.lit(False))).drop(DROP_MARK)


def create(name: str, value: str):
    """Constant, only where the field is absent."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        return put(df, {name: F.lit(value)}, when & optional(df, name).isNull())

    return step


def create_from(name: str, source: str):
    """Value of another field ('' when that is absent), only where the field is absent."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        return put(df, {name: nz(optional(df, source))}, when & optional(df, name).isNull())

    return step


def insert(name: str, value: str):
    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        return put(df, {name: F.lit(value)}, when)

    return step


def insert_from(name: str, source: str):
    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        return put(df, {name: nz(optional(df, source))}, when)

    return step


def rename(name: str, new: str):
    """Move a field; rows without it keep what ``new`` holds."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        if name not in df.columns:
            return df
        df = put(df, {new: field(name)}, when & field(name).isNotNull())
        return df.drop(name) if when is ALWAYS else put(df, {name: F.lit(None)}, when)

    return step


def _wrapped_int(c: Column) -> Column:
    """32-bit wrap-around of a bigint result."""
    return F.pmod(c + F.lit(1 << 31), F.lit(1 << 32)) - F.lit(1 << 31)


def _int_quotient(a: Column, b: Column) -> Column:
    # a double holds every quotient of two 32-bit numbers closely enough to cut
    exact = (F.abs(a) - F.abs(a) % F.abs(b)) / F.abs(b)
    return F.when(b != 0, (exact * F.signum(a) * F.signum(b)).cast("bigint"))


def _remainder(a: Column, b: Column) -> Column:
    return F.when(b != 0, a % F.when(b != 0, b))


_INT_OPS = {
    "+": lambda a, b: _wrapped_int(a + b),
    "-": lambda a, b: _wrapped_int(a - b),
    "*": lambda a, b: _wrapped_int(a * b),
    "/": lambda a, b: _wrapped_int(_int_quotient(a, F.when(b != 0, b))),
    "%": _remainder,
}
_DOUBLE_OPS = {
    ".+": lambda a, b: a + b,
    ".-": lambda a, b: a - b,
    ".*": lambda a, b: a * b,
    "./": lambda a, b: F.when(b != 0, a / F.when(b != 0, b)).when((a == 0) | F.isnan(a), F.lit(float("nan"))).otherwise(a * F.lit(float("inf"))),
    ".%": lambda a, b: F.when(b != 0, a % F.when(b != 0, b)).otherwise(F.lit(float("nan"))),
}


def arithmetic(name: str, op: str, operands: Sequence[Column | str | int | float]):
    """Left fold of the present operands, written to ``name`` as text.

    A string operand names a field, a number or Column is a value. With fewer
    than two operands present, or one that is no number, the field keeps what it
    has. Integer operators wrap at 32 bits and cut towards zero; a zero divisor
    changes nothing. Double operators carry a leading dot.
    """

    def operand(df: DataFrame, x) -> Column:
        if isinstance(x, str):
            return optional(df, x).cast("string")
        return (x if isinstance(x, Column) else F.lit(str(x))).cast("string")

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        present = F.filter(F.array(*[operand(df, x) for x in operands]), lambda t: t.isNotNull())
        if op in _INT_OPS:
            def number(t: Column) -> Column:
                return F.when(t.rlike(r"\A[+-]?\d+\z"), t.try_cast("int")).cast("bigint")
        elif op in _DOUBLE_OPS:
            def number(t: Column) -> Column:
                return t.try_cast("double")
        else:
            raise ValueError(f"unsupported operator {op}")
        combine = (_INT_OPS | _DOUBLE_OPS)[op]

        def fold(a: Column) -> Column:
            return F.when(
                F.size(a) > 1, F.aggregate(F.slice(a, F.lit(2), F.size(a) - 1), F.get(a, F.lit(0)), combine)
            )

        result = let(F.transform(present, number), fold).cast("string")
        return put(df.withColumn("_result", result), {name: F.col("_result")}, when & F.col("_result").isNotNull()).drop(
            "_result"
        )

    return step


def replace(name: str, regex: str, value: str):
    """Replace every match of ``regex`` by a constant."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        old = optional(df, name)
        return put(df, {name: F.regexp_replace(old, regex, value)}, when & old.isNotNull())

    return step


def replace_from(name: str, regex: str, source: str):
    """Replace every match of ``regex`` by another field's value; both must be present."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        old, new = optional(df, name), optional(df, source)
        return put(df, {name: F.regexp_replace(old, F.lit(regex), new)}, when & old.isNotNull() & new.isNotNull())

    return step
