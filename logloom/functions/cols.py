"""Small column helpers used by the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Always:
    """Guard of a step that runs on every row; ``ALWAYS & c`` is ``c``."""

    def __and__(self, other: Column) -> Column:
        return other


ALWAYS = _Always()


def masked(when: Column | _Always, c: Column) -> Column:
    """``c`` on rows where the guard holds, NULL elsewhere."""
    return c if when is ALWAYS else F.when(when, c)


def field(name: str) -> Column:
    """Column by exact name, also when it holds dots or '@'."""
    return F.col("`" + name.replace("`", "``") + "`")


def optional(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """Column ``name``, or a typed NULL when the frame lacks it (absent key = NULL)."""
    return field(name) if name in df.columns else F.lit(None).cast(dtype)


def nz(c: Column, default: str = "") -> Column:
    return F.coalesce(c, F.lit(default))


def try_whole(c: Column, dtype: str = "bigint") -> Column:
    """Whole number of a text, NULL where it is none.

    A failing cast costs an exception, so a text with a character that no whole number has is not cast.
    """
    text = c.cast("string")
    return F.when((text != "") & ~text.rlike(r"[!-*,./:-~]"), c.try_cast(dtype))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def put(df: DataFrame, values: Mapping[str, Column], hit: Column) -> DataFrame:
    """Write ``values`` on rows where ``hit`` holds; other rows keep what they had."""
    if hit is ALWAYS:
        return df.withColumns(dict(values))
    return df.withColumns(
        {
            name: F.when(hit, value).otherwise(field(name)) if name in df.columns else F.when(hit, value)
            for name, value in values.items()
        }
    )


def last_wins_map(entries: Column) -> Column:
    """``array<struct<k,v>>`` to a map in which the last entry of a key wins.

    Sort by (key, position) and keep the last of each run, so the cost is
    n log n in the number of entries and independent of session settings.
    """
    ranked = F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"), e["v"].alias("v")))

    def keep_last(a: Column) -> Column:
        return F.filter(a, lambda e, i: F.coalesce(F.get(a, i + 1)["k"] != e["k"], F.lit(True)))

    kept = let(F.array_sort(ranked), keep_last)
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"])))


def map_text(m: Column) -> Column:
    """Canonical text of a string map: ``k=v`` entries in key order, joined by ``;``."""
    pairs = F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), nz(e["value"], "\\N")))
    return F.array_join(F.array_sort(pairs), ";")


_BLOCK = 16


def running_starts(lengths: Column, levels: int = 2) -> Column:
    """Exclusive prefix sums of an int array.

    Entries are summed up in blocks, the block sums in turn as well, so an entry
    only adds the few before it in its own block instead of all before it.
    """

    def total(a: Column, start: Column, n: Column) -> Column:
        return F.aggregate(F.slice(a, start, n), F.lit(0), lambda s, x: s + x)

    def block(i: Column) -> Column:
        return F.shiftright(i, _BLOCK.bit_length() - 1)

    def starts(a: Column) -> Column:
        if levels == 0:
            return F.transform(a, lambda _, i: total(a, F.lit(1), i))
        sums = F.transform(
            F.sequence(F.lit(0), block(F.size(a) - 1)), lambda b: total(a, b * _BLOCK + 1, F.lit(_BLOCK))
        )
        return let(
            running_starts(sums, levels - 1),
            lambda base: F.transform(
                a, lambda _, i: F.get(base, block(i)) + total(a, block(i) * _BLOCK + 1, i % _BLOCK)
            ),
        )

    return let(lengths, lambda a: F.when(F.size(a) > 0, starts(a)))
