"""Date step: writes ``event_timestamp`` in epoch millis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, optional, put
from logloom.functions.dates import now_millis, parse_first

# fixed value: the format used when none is given
DEFAULT_FORMATS = (("yyyy-MM-dd'T'HH:mm:ss.SSSZ", "UTC"),)


def date(
    target: str = "timestamp",
    formats: Sequence[tuple] | Mapping[str, Sequence[tuple]] = DEFAULT_FORMATS,
    fallback_now: bool = False,
    now: int | None = None,
    output: str = "event_timestamp",
    type_field: str = "type",
):
    """Step that parses ``target`` with the first ``(format[, zone[, locale]])`` that fits.

    ``formats`` may be given per event type. Text that fits none gives NULL, or
    the current time (``now`` if given) with ``fallback_now``.
    """

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        text = optional(df, target)
        if isinstance(formats, Mapping):
            kind = optional(df, type_field)
            millis = F.coalesce(*[F.when(kind == t, parse_first(text, list(f))) for t, f in formats.items()])
        else:
            millis = parse_first(text, list(formats))
        if fallback_now:
            millis = F.coalesce(millis, now_millis(now))
        return put(df, {output: millis}, when)

    return step
