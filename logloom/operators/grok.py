"""Grok extraction with one native regex pass per pattern.

The expanded pattern is wrapped so that a single ``regexp_replace`` turns a
matching text into its groups joined by a separator, which ``split`` takes
apart again. Running one ``regexp_extract`` per group would scan the text once
per group. A text without match keeps no separator, which tells the two apart
without a second ``rlike`` pass. The separator is one constant; the rare text that
holds it is taken apart by its numbered groups instead, so it comes back whole.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, field, let, masked, optional
from logloom.operators.grok_library import EVENT_TYPES, LIBRARY

#: Between captures. No end of it is its start, so it is found where it was put, also beside its own characters.
_SEP = "\u0001\u0002\u0003"
_REFERENCE = re.compile(r"%\{([^}:]+)(?::([^}:]+))?\}")
_GROUP = re.compile(r"\(\?<([A-Za-z][A-Za-z0-9]*)>")


def library_with(patterns: Mapping[str, str] | None = None) -> dict[str, str]:
    """The shipped library with user patterns on top; a user pattern replaces a shipped one."""
    return {**LIBRARY, **(patterns or {})}


def expand(text: str, library: Mapping[str, str] = LIBRARY, prefix: str = "") -> str:
    """Resolve ``%{NAME}`` and ``%{NAME:field}`` to a plain regex.

    A named reference inside field ``g`` becomes ``gxinner``, since group names
    take letters and digits only.
    """

    def resolve(ref: re.Match) -> str:
        name, group = ref.groups()
        if group is None:
            return f"(?:{expand(library[name], library, prefix)})"
        full = f"{prefix}x{group}" if prefix else group
        return f"(?<{full}>{expand(library[name], library, full)})"

    return _REFERENCE.sub(resolve, text)


def group_names(regex: str) -> list[str]:
    return list(dict.fromkeys(_GROUP.findall(regex)))


def group_numbers(regex: str) -> dict[str, int]:
    """Number of each named group; all capturing groups count, from left to right."""
    numbers: dict[str, int] = {}
    n, at, in_class = 0, 0, 0
    while at < len(regex):
        if regex.startswith(r"\Q", at):
            at = regex.find(r"\E", at) + 1 or len(regex)
        elif regex[at] == "\\":
            at += 1
        elif regex[at] == "[":
            in_class += 1
        elif regex[at] == "]" and in_class:
            in_class -= 1
        elif regex[at] == "(" and not in_class:
            named = _GROUP.match(regex, at)
            if named or not regex.startswith("(?", at):
                n += 1
            if named:
                numbers.setdefault(named.group(1), n)
        at += 1
    return numbers


def _pieces(text: str, regex: str, captures: Sequence[str]) -> Column:
    """Array ``['', capture 1, capture 2, ...]`` of the first match in column ``text``; one element without match."""
    whole = F.lit(rf"\A(?s:.*?)(?:{regex})(?s:.*)\z")
    c, sep, at = field(text), F.lit(_SEP), group_numbers(regex)
    joined = F.lit("".join(_SEP + "${" + name + "}" for name in captures) or _SEP)
    numbers = F.lit([0, *(at[name] for name in captures)])
    by_number = F.transform(numbers, lambda i: F.when(i == 0, "").otherwise(F.call_function("regexp_extract", c, F.lit(regex), i)))
    return F.when(F.contains(c, sep), F.when(F.rlike(c, F.lit(regex)), by_number).otherwise(F.array(c))).otherwise(
        F.split(F.regexp_replace(c, whole, joined), _SEP)
    )


def _matched(pieces: Column) -> Column:
    return F.coalesce(F.size(pieces) > 1, F.lit(False))


def extract(
    df: DataFrame,
    target: str,
    name: str,
    library: Mapping[str, str] = LIBRARY,
    when: Column = ALWAYS,
    tag: str = "",
) -> DataFrame:
    """Fields of pattern ``name`` found in column ``target``; rows without match stay as they are.

    A group that took no part, or matched empty text, gives NULL.
    """
    regex = expand(library[name], library)
    names = group_names(regex)
    pieces, text = f"_grok{tag}_{name}", f"_text{tag}_{name}"
    df = df.withColumn(text, masked(when, optional(df, target))).withColumn(pieces, _pieces(text, regex, names))
    return _put_groups(df, pieces, names).drop(pieces, text)


def _put_groups(df: DataFrame, pieces: str, names: Sequence[str]) -> DataFrame:
    """Write the groups held in array column ``pieces`` where there was a match."""
    return df.withColumns(
        {
            n: F.expr(
                f"CASE WHEN size(`{pieces}`) > 1 THEN nullif(get(`{pieces}`, {i}), '') "
                + (f"ELSE `{n}` END" if n in df.columns else "END")
            )
            for i, n in enumerate(names, 1)
        }
    )


def grok(
    target: str = "message",
    matches: Sequence[str] = (),
    patterns: Mapping[str, str] | None = None,
    mode: str = "merge",
    types: Sequence[str] = EVENT_TYPES,
    type_field: str = "type",
):
    """Step that extracts named groups.

    With ``matches`` every listed pattern is tried: ``merge`` lets later matches
    overwrite, ``first`` stops at the first that fits. Without ``matches`` the
    pattern is the one named like the event's type, for the given ``types``.
    Unknown pattern names are skipped.
    """
    library = library_with(patterns)

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        if not matches:
            for t in (t for t in types if t in library):
                df = extract(df, target, t, library, when & (optional(df, type_field) == t))
            return df
        # all patterns read the text as it was before the step
        known = [m for m in matches if m in library]
        df = df.withColumn("_grok_text", optional(df, target))
        if mode == "merge":
            for i, m in enumerate(known):
                df = extract(df, "_grok_text", m, library, when, str(i))
            return df.drop("_grok_text")
        free = when
        for i, m in enumerate(known):
            regex = expand(library[m], library)
            names = group_names(regex)
            at, text = f"_grok{i}", f"_text{i}"
            df = df.withColumn(text, masked(free, field("_grok_text"))).withColumn(at, _pieces(text, regex, names))
            free = free & ~_matched(field(at))
        for i, m in enumerate(known):
            names = group_names(expand(library[m], library))
            df = _put_groups(df, f"_grok{i}", names)
        return df.drop("_grok_text", *[f"_{kind}{i}" for kind in ("grok", "text") for i in range(len(known))])

    return step


SPAN_TYPE = "array<struct<name:string,start:int,end:int,value:string>>"


def spans(text: str, name: str, library: Mapping[str, str] = LIBRARY) -> Column:
    """Groups of the first match in column ``text`` with their character positions, NULL without match.

    At the head of every named group a look-ahead captures the rest of the text,
    whose length gives the start of the group; this stays in the same regex engine
    as the extraction. A group without text gets the span of the whole text.
    """
    regex = expand(library[name], library)
    names = group_names(regex)
    marked = _GROUP.sub(lambda g: rf"{g.group(0)}(?=(?<{g.group(1)}Zrest>(?s:.*)\z))", regex)
    pieces = _pieces(text, marked, [x for n in names for x in (n, n + "Zrest")])
    length = F.length(field(text))

    def build(a: Column) -> Column:
        rows = []
        for i, n in enumerate(names):
            value, rest = F.get(a, F.lit(2 * i + 1)), F.get(a, F.lit(2 * i + 2))
            absent = F.length(value) == 0
            start = F.when(absent, 0).otherwise(length - F.length(rest))
            end = F.when(absent, length).otherwise(length - F.length(rest) + F.length(value))
            rows.append(
                F.struct(
                    F.lit(n).alias("name"),
                    start.alias("start"),
                    end.alias("end"),
                    F.when(~absent, value).alias("value"),
                )
            )
        return F.array(*rows)

    found = let(pieces, lambda a: F.when(F.size(a) > 1, build(a)))
    return found.cast(SPAN_TYPE)


def first_spans(text: str, names: Sequence[str], library: Mapping[str, str] = LIBRARY) -> Column:
    """Spans of the first listed pattern that fits column ``text``."""
    return F.coalesce(*[spans(text, n, library) for n in names if n in library])
