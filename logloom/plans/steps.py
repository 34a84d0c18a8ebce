"""Step lists: the ordered, guarded enrichment of events.

A step is a function ``(df, when) -> df`` that only changes rows on which the
guard ``when`` holds. Routing guards each type's steps inside one projection
chain, so however many types there are, the input is scanned once and nothing
is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, field, nz, optional
from logloom.functions.predicates import all_of
from logloom.sources.decode import UNKNOWN

Step = Callable[..., DataFrame]
ANY = "*"


def with_fields(df: DataFrame, names: Iterable[str], dtype: str = "string") -> DataFrame:
    """Add the named columns as NULL where the frame lacks them."""
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast(dtype) for n in missing}) if missing else df


def require(step: Step, *conditions: Column, fields: Iterable[str] = ()) -> Step:
    """``step`` on rows that pass all conditions, as the row stands when the step runs.

    ``fields`` names columns the conditions read that may be absent so far.
    """

    def guarded(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        df = with_fields(df, fields)
        return step(df, when & all_of(*conditions)) if conditions else step(df, when)

    return guarded


def run(df: DataFrame, steps: Sequence[Step], when: Column = ALWAYS) -> DataFrame:
    for step in steps:
        df = step(df, when)
    return df


def route(
    df: DataFrame,
    table: Mapping[str, Mapping[str, Sequence[Step]]],
    token_field: str = "token",
    type_field: str = "type",
) -> DataFrame:
    """Run the steps of ``table[token][type]`` on the matching rows.

    A token of its own comes before ``*``, and within a token a type before
    ``*``. Rows that nothing matches pass through unchanged.
    """
    own = {t: types for t, types in table.items() if t != ANY}
    for token, types in table.items():
        for type_, steps in types.items():
            # the guard is fixed before the steps may change token or type
            guard = F.lit(True)
            kind, holder = nz(optional(df, type_field), UNKNOWN), nz(optional(df, token_field), UNKNOWN)
            if type_ != ANY:
                guard = guard & (kind == type_)
            else:
                named = [t for t in types if t != ANY]
                guard = guard & (~kind.isin(named) if named else F.lit(True))
            if token != ANY:
                guard = guard & (holder == token)
            else:
                for other, other_types in own.items():
                    covered = F.lit(True) if ANY in other_types else kind.isin(list(other_types))
                    guard = guard & ~((holder == other) & covered)
            df = df.withColumn("_route", guard)
            df = run(df, steps, field("_route")).drop("_route")
    return df
