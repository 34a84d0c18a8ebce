"""Timestamp text to epoch milliseconds, independent of the session time zone."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.cols import try_whole

_TOKEN = re.compile(r"'[^']*'|([A-Za-z])\1*|.", re.S)
_LOOSE = {"dd", "HH", "hh", "mm", "ss", "MM", "kk", "KK"}
_NUMERIC = set("yuMdHhmsSkKDn")
_ZONE = set("ZXxVzO")


def _tokens(fmt: str) -> list[str]:
    return [m.group(0) for m in _TOKEN.finditer(fmt)]


def _numeric(token: str) -> bool:
    return token[0] in _NUMERIC and not token.startswith("MMM")


def _loosen(tokens: list[str]) -> list[str]:
    """Two-digit fields also accept one digit, unless they touch another number."""
    out = []
    for i, token in enumerate(tokens):
        touching = (i > 0 and _numeric(tokens[i - 1])) or (i + 1 < len(tokens) and _numeric(tokens[i + 1]))
        out.append(token[0] if token in _LOOSE and not touching else token)
    return out


def parse_millis(c: Column, fmt: str, tz: str = "UTC", locale: str = "en") -> Column:
    """Epoch millis of ``c`` read with ``fmt``; NULL where the text does not fit.

    ``tz`` applies when the format carries no zone of its own. A leading day
    name is dropped from format and text, because it adds no information and
    Spark's parser refuses it. ``epoch_millis`` is accepted as a format name.
    A text that lacks a character of the format is not parsed, since a failed parse costs an exception.
    """
    if fmt == "epoch_millis":
        return try_whole(c)
    raw = c
    tokens = [t.replace("Y", "y") if t[0] == "Y" else t for t in _tokens(fmt)]
    if tokens and tokens[0][0] == "E":
        tokens = tokens[1:]
        while tokens and not tokens[0][0].isalpha():
            tokens = tokens[1:]
        c = F.regexp_replace(c, r"\A\s*\p{L}+\.?[^\p{L}\p{N}]*", "")
    if any(t[0] == "E" for t in tokens):
        raise ValueError(f"day name is only supported at the start of a format: {fmt}")

    marks = _marks(tokens)
    zone_at = [i for i, t in enumerate(tokens) if t[0] in _ZONE]
    if not zone_at:
        tokens += [" ", "VV"]
        c = F.concat(c, F.lit(f" {tz}"))
        variants = [tokens]
    elif tokens[zone_at[0]] == "ZZZ":
        variants = [tokens[: zone_at[0]] + ["VV"] + tokens[zone_at[0] + 1 :]]
    elif tokens[zone_at[0]][0] == "Z":
        # an offset is written +0800, +08:00 or Z
        variants = [tokens[: zone_at[0]] + [z] + tokens[zone_at[0] + 1 :] for z in ("XX", "XXX")]
    else:
        variants = [tokens]
    parsed = [_read(c, "".join(_loosen(v)), locale) for v in variants]
    # the first variant reads all offsets without a colon, and Z
    parsed[1:] = [F.when(raw.rlike(r"[-+][0-9]{2}:[0-9]{2}"), p) for p in parsed[1:]]
    millis = F.unix_millis(F.coalesce(*parsed))
    return F.when(reduce(lambda a, b: a & b, [raw.contains(m) for m in marks]), millis) if marks else millis


def _marks(tokens: list[str]) -> list[str]:
    """Characters that any text of the format holds: its signs and spaces outside of quotes; none with optional sections."""
    if any(t in "[]{}#" for t in tokens):
        return []
    return sorted({t for t in tokens if len(t) == 1 and not t.isalnum() and t != "'"})


def _read(c: Column, fmt: str, locale: str) -> Column:
    if locale.split("-")[0] == "en":
        return F.try_to_timestamp(c, F.lit(fmt))
    options = {"timestampFormat": fmt, "locale": locale, "sep": "\u0001", "quote": ""}
    return F.from_csv(c, "t timestamp", options)["t"]


def parse_first(c: Column, formats: list[tuple]) -> Column:
    """First of several ``(fmt[, tz[, locale]])`` settings that fits."""
    return F.coalesce(*[parse_millis(c, *setting) for setting in formats])


def strict_utc_millis(c: Column) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'`` in UTC, as shippers write it."""
    return F.when(c.endswith("Z"), F.unix_millis(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX"))))


def now_millis(now: int | None = None) -> Column:
    return F.unix_millis(F.current_timestamp()) if now is None else F.lit(now).cast("bigint")
