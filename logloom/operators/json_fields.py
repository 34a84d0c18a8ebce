"""JSON path extraction and flattening with variant values; no shuffle, no Python rows.

A found value is opened level by level inside the row: objects give one entry
per key, arrays one per index, scalars stay. The key of an entry is its leaf
name, or the path's names joined by ``-`` when the path itself hits a scalar.
Paths have names, indexes, wildcards, recursive steps, slices, unions and tests.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, last_wins_map, let, masked, optional, put

REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"
#: Containers inside containers that a recursive step ``..`` looks into.
MAX_DEPTH = 10
_PATH_TOKEN = re.compile(
    r"\.length\(\)|\[\*\]|(?P<deep>\.\.)(?=[^.])|\.\*|\.(?P<dot>[^.\[\]()*]+)|\['(?P<quoted>[^',]*)'\]|\[(?P<index>-?\d+)\]"
    r"|\[(?P<slice>-?\d*:-?\d*)\]|\[(?P<many>-?\d+(?:\s*,\s*-?\d+)+)\]|\[(?P<names>'[^']*'(?:\s*,\s*'[^']*')+)\]|\[\?\((?P<test>(?:'[^']*'|[^'])*?)\)\]"
)
_TEST = re.compile(
    r"\s*(?P<left>@(?:\.[^.\[\]()*\s=!<>&|]+|\['[^']*'\])*)\s*(?:(?P<op>==|!=|<=|>=|<|>)\s*(?P<right>'[^']*'|-?\d+(?:\.\d+)?|true|false|null))?\s*"
)


def _tokens(path: str) -> list[tuple]:
    """``$.a['b'][0][*].length()`` as steps (kind, value).

    Kinds: name, index, any, deep (``..``), length, slice, many (several indexes), names, test.
    """
    if not path.startswith("$"):
        raise ValueError(f"a JSON path starts with $: {path}")
    steps: list[tuple] = []
    at, deep = 1, False
    while at < len(path):
        # after '..' a name stands without its dot
        m = _PATH_TOKEN.match(path, at) if not deep or path[at] == "[" else _PATH_TOKEN.match(f".{path[at:]}")
        if not m or deep and m["deep"]:
            raise ValueError(f"unsupported JSON path: {path}")
        at += m.end() - m.start() - (1 if deep and path[at] != "[" else 0)
        deep = bool(m["deep"])
        if m["deep"]:
            steps.append(("deep", None))
        elif m["dot"] or m["quoted"] is not None:
            steps.append(("name", m["dot"] or m["quoted"]))
        elif m["index"]:
            steps.append(("index", int(m["index"])))
        elif m["slice"]:
            steps.append(("slice", tuple(int(x) if x else None for x in m["slice"].split(":"))))
        elif m["many"]:
            steps.append(("many", [int(x) for x in m["many"].split(",")]))
        elif m["names"]:
            steps.append(("names", re.findall(r"'([^']*)'", m["names"])))
        elif m["test"]:
            steps.append(("test", _tests(m["test"], path)))
        else:
            steps.append(("length" if m[0] == ".length()" else "any", None))
    if deep:
        raise ValueError(f"unsupported JSON path: {path}")
    return steps


def _tests(text: str, path: str) -> list[list[tuple]]:
    """``@.a > 1 && @.b || @.c == 'x'`` as alternatives of conditions (path pieces, operator, literal)."""
    out, at = [[]], 0
    while True:
        m = _TEST.match(text, at)
        if not m:
            raise ValueError(f"unsupported JSON path: {path}")
        pieces = [a or b for a, b in re.findall(r"\.([^.\[\]()*\s=!<>&|]+)|\['([^']*)'\]", m["left"])]
        out[-1].append((pieces, m["op"], m["right"]))
        at = m.end()
        if at == len(text):
            return out
        if text[at : at + 2] not in ("&&", "||"):
            raise ValueError(f"unsupported JSON path: {path}")
        if text[at : at + 2] == "||":
            out.append([])
        at += 2


def _one_value(steps: list[tuple]) -> bool:
    """True for a path that selects at most one value."""
    return all(kind in ("name", "index", "length", "names") for kind, _ in steps)


def path_name(path: str) -> str:
    """Names and indexes of the path; a function goes by its name, a choice of several by nothing."""
    named = {"name", "index", "length"}
    return "-".join("length" if kind == "length" else str(value) for kind, value in _tokens(path) if kind in named)


def _as_map(v: Column) -> Column:
    return v.try_cast("map<string,variant>")


def _as_array(v: Column) -> Column:
    return v.try_cast("array<variant>")


def _no_variants() -> Column:
    return F.array().cast("array<variant>")


def _held(v: Column) -> Column:
    """What a container holds, NULL for any other value."""
    return F.coalesce(_as_array(v), F.map_values(_as_map(v)))


def _children(v: Column) -> Column:
    return F.coalesce(_held(v), _no_variants())


def _below(v: Column, depth: int = MAX_DEPTH) -> Column:
    """``v`` and the containers in it, each before what it holds. Each container is opened once."""

    def go(v: Column, held: Column, depth: int) -> Column:
        if depth == 0:
            return F.array(v)
        inner = F.transform(held, lambda c: F.struct(c.alias("v"), _held(c).alias("held")))
        inner = F.filter(inner, lambda e: e["held"].isNotNull())
        return F.concat(F.array(v), F.flatten(F.transform(inner, lambda e: go(e["v"], e["held"], depth - 1))))

    return let(_children(v), lambda held: go(v, held, depth))


def _quoted(name: str) -> str:
    return f"['{name}']"


def _at(array: Column, i: int) -> Column:
    """Element ``i``, from the end where negative; NULL outside."""
    return F.get(array, F.lit(i)) if i >= 0 else F.get(array, F.size(array) + i)


def _part(array: Column, low: int | None, high: int | None) -> Column:
    n = F.size(array)

    def bound(x: int) -> Column:
        return F.least(n, F.lit(x)) if x >= 0 else F.greatest(F.lit(0), n + x)

    start = F.lit(0) if low is None else bound(low)
    end = n if high is None else bound(high)
    return F.slice(array, start + 1, F.greatest(F.lit(0), end - start))


def _holds(v: Column, tests: list[list[tuple]]) -> Column:
    def one(pieces: list[str], op: str | None, right: str | None) -> Column:
        left = F.try_variant_get(v, "$" + "".join(map(_quoted, pieces)), "variant") if pieces else v
        if op is None:
            return left.isNotNull()
        if right == "null":
            same = F.coalesce(F.is_variant_null(left), F.lit(False))
            return same if op == "==" else left.isNotNull() & ~same
        kind = F.schema_of_variant(left)
        if right.startswith("'"):
            value, literal, fits = left.try_cast("string"), F.lit(right[1:-1]), kind == "STRING"
        elif right in ("true", "false"):
            value, literal, fits = left.try_cast("boolean"), F.lit(right == "true"), kind == "BOOLEAN"
        else:
            value, literal, fits = left.try_cast("double"), F.lit(float(right)), (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
        hit = {
            "==": value == literal, "!=": value != literal, "<": value < literal, "<=": value <= literal, ">": value > literal, ">=": value >= literal,
        }[op]
        # values of another type are never equal or ordered
        return F.when(left.isNotNull(), F.when(fits, hit).otherwise(op == "!="))

    def all_of(conditions: list[tuple]) -> Column:
        return reduce(lambda a, b: a & b, [F.coalesce(one(*c), F.lit(False)) for c in conditions])

    return reduce(lambda a, b: a | b, [all_of(c) for c in tests])


def _reached(here: Column, kind: str, value) -> Column:
    """Values that one step reaches from a value."""
    if kind == "any":
        return _children(here)
    if kind == "deep":
        return _below(here)
    if kind == "length":
        size = F.coalesce(F.size(_as_array(here)), F.size(_as_map(here)))
        return F.array(F.try_parse_json(size.cast("string")))
    if kind == "index":
        return F.array(_at(_as_array(here), value))
    if kind == "many":
        return let(_as_array(here), lambda a: F.array(*[_at(a, i) for i in value]))
    if kind == "slice":
        return let(_as_array(here), lambda a: F.coalesce(_part(a, *value), _no_variants()))
    if kind == "names":
        # several names make one object of them
        own = F.map_filter(_as_map(here), lambda k, _: k.isin(*value))
        return F.array(F.when(F.size(own) > 0, F.try_parse_json(F.to_json(own))))
    if kind == "test":
        # a test looks at the elements of an array, or at an object itself
        return F.filter(F.coalesce(_as_array(here), F.array(here)), lambda e: _holds(e, value))
    return F.array(F.try_variant_get(here, "$" + _quoted(value), "variant"))


def _plain(steps: list[tuple]) -> tuple[str, list[tuple]]:
    """The names and indexes that ``steps`` begin with as one path, and the other steps."""
    plain = ""
    for k, (kind, value) in enumerate(steps):
        if kind == "name":
            plain += _quoted(value)
        elif kind == "index" and value >= 0:
            plain += f"[{value}]"
        else:
            return plain, steps[k:]
    return plain, []


def _walk(v: Column, steps: list[tuple]) -> Column:
    """All values a path selects below ``v``, as ``array<variant>``."""
    plain, rest = _plain(steps)
    here = F.try_variant_get(v, "$" + plain, "variant") if plain else v
    if not rest:
        return F.filter(F.array(here), lambda x: x.isNotNull())
    (kind, value), rest = rest[0], rest[1:]

    def go(here: Column) -> Column:
        found = _reached(here, kind, value)
        path, more = _plain(rest)
        if path and not more:
            found = F.transform(found, lambda e: F.try_variant_get(e, "$" + path, "variant"))
            return F.filter(found, lambda x: x.isNotNull())
        found = F.filter(found, lambda x: x.isNotNull())
        return F.flatten(F.transform(found, lambda e: _walk(e, rest))) if rest else found

    return F.coalesce(let(here, go), _no_variants())


def _entry(k: Column, v: Column) -> Column:
    return F.struct(k.alias("k"), v.alias("v"))


def _open(entries: Column) -> Column:
    """One level down: containers are replaced by their entries."""

    def children(e: Column) -> Column:
        from_map = F.transform(F.map_entries(_as_map(e["v"])), lambda x: _entry(x["key"], x["value"]))
        from_array = F.transform(_as_array(e["v"]), lambda x, i: _entry(i.cast("string"), x))
        return F.coalesce(from_map, from_array, F.array(_entry(e["k"], e["v"])))

    return F.flatten(F.transform(entries, children))


def _text(v: Column) -> Column:
    """Text of a leaf; fractions print like a JVM double, containers as JSON."""

    def by_kind(kind: Column) -> Column:
        precision = F.regexp_extract(kind, r"^DECIMAL\((\d+),", 1).try_cast("int")
        fraction = (kind == "DOUBLE") | (kind.startswith("DECIMAL") & ~(kind.endswith(",0)") & (precision > 18)))
        return (
            F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.to_json(v))
            .when(fraction, v.try_cast("double").cast("string"))
            .otherwise(v.try_cast("string"))
        )

    return let(F.schema_of_variant(v), by_kind)


def parsed(c: Column) -> Column:
    """Variant of a JSON text; NULL when empty or malformed.

    Of repeated keys the last wins: for that the session setting :data:`REPEATED_KEYS` is turned on here.
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set(REPEATED_KEYS, "true")
    return F.try_parse_json(F.nullif(F.trim(c), F.lit("")))


def parse_failed(c: Column) -> Column:
    return F.coalesce((F.trim(c) != "") & parsed(c).isNull(), F.lit(False))


def path_missing(v: Column, path: str) -> Column:
    return v.isNotNull() & (F.size(_walk(v, _tokens(path))) == 0)


def path_text(v: Column, path: str) -> Column:
    """Text of the first value the path selects in a :func:`parsed` variant."""
    return let(F.get(_walk(v, _tokens(path)), F.lit(0)), lambda x: F.when(~F.is_variant_null(x), _text(x)))


def json_values(target: str, paths: dict[str, str]):
    """Step that writes the value of each path to its column; the text is parsed once."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        df = df.withColumn("_json", parsed(masked(when, optional(df, target))))
        df = df.withColumns({f"_json_{i}": path_text(F.col("_json"), p) for i, p in enumerate(paths.values())})
        for i, name in enumerate(paths):
            df = put(df, {name: F.col(f"_json_{i}")}, F.col(f"_json_{i}").isNotNull())
        return df.drop("_json", *[f"_json_{i}" for i in range(len(paths))])

    return step


def _flat_entries(v: Column, path: str, max_level: int) -> Column:
    steps = _tokens(path)
    found = _walk(v, steps)
    if not _one_value(steps):
        # the selected values form one array, which uses up a level
        entries, levels = F.transform(found, lambda x, i: _entry(i.cast("string"), x)), max_level - 1
    else:
        entries, levels = F.transform(found, lambda x: _entry(F.lit(path_name(path)), x)), max_level
    for _ in range(levels):
        entries = _open(entries)
    kept = F.filter(entries, lambda e: ~F.is_variant_null(e["v"]))
    return F.transform(kept, lambda e: _entry(e["k"], _text(e["v"])))


def flatten(c: Column, paths: Sequence[str] = ("$",), max_level: int = 3) -> Column:
    """``map<string,string>`` of everything the paths select; the last of a key wins.

    Containers left at ``max_level`` are kept as JSON text, JSON nulls are skipped.
    """

    def of_variant(v: Column) -> Column:
        entries = [_flat_entries(v, p, max_level) for p in paths]
        return F.when(v.isNotNull(), last_wins_map(F.concat(*entries) if len(entries) > 1 else entries[0]))

    return let(parsed(c), of_variant)


def json_fields(target: str, paths: Sequence[str] = ("$",), max_level: int = 5, output: str | None = None):
    """Step that writes the flattened JSON of ``target`` to the map column ``<target>_json``."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        name = output or f"{target}_json"
        df = df.withColumn("_json", flatten(masked(when, optional(df, target)), paths, max_level))
        return put(df, {name: F.col("_json")}, F.col("_json").isNotNull()).drop("_json")

    return step
