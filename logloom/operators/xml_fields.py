"""XML paths and flattening, inside the JVM and in one pass over the text.

``regexp_extract_all`` cuts a text into tags, texts, comments and the like; a fold over these tokens keeps the open
elements and gives the nodes in document order, each with the ids and names of the elements above it. The same fold sees
whether the text is well formed. Paths are selections on the array of nodes. The XML to variant conversion is no way to
do this here: it raises on malformed text, turns texts like 007 into numbers and loses the document order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, last_wins_map, let, masked, optional, put

_NAME = r"[A-Za-z_:\x{80}-\x{10FFFF}][-A-Za-z0-9._:\x{80}-\x{10FFFF}]*"
_ATTRIBUTE = rf"{_NAME}\s*=\s*(?:\"[^<\"]*\"|\x27[^<\x27]*\x27)"
_TOKEN = rf"<!--[\s\S]*?-->|<!\[CDATA\[[\s\S]*?\]\]>|<\?{_NAME}(?:\?>|\s[\s\S]*?\?>)|</{_NAME}\s*>|<{_NAME}(?:\s+{_ATTRIBUTE})*\s*/?>|[^<]+"
#: References that are neither predefined nor a character, and so would need a document type.
_FOREIGN = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6});)|&#0+;|&#x0+;"

_NODE = "struct<kind:string,id:int,up:array<int>,names:array<string>,name:string,value:string>"


def _raw(pattern: str) -> str:
    return f"r'{pattern}'"


# character references become characters; '&amp;' comes last, so that what it yields is not read again
_CODE = "CASE WHEN startswith(p, 'x') THEN conv(substr(substring_index(p, ';', 1), 2), 16, 16) ELSE conv(substring_index(p, ';', 1), 10, 16) END"
_CHARACTER = f"concat(decode(unhex(lpad({_CODE}, 8, '0')), 'UTF-32'), substr(p, instr(p, ';') + 1))"


def _decoded(text: str) -> str:
    numbers = f"array_join(transform(split({text}, '&#'), (p, i) -> CASE WHEN i = 0 THEN p ELSE {_CHARACTER} END), '')"
    plain = f"CASE WHEN contains({text}, '&#') THEN {numbers} ELSE {text} END"
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", r"\'"), ("amp", "&")):
        plain = f"replace({plain}, '&{name};', '{character}')"
    return f"CASE WHEN contains({text}, '&') THEN {plain} ELSE {text} END"


_PAIRS = f"regexp_extract_all(x, {_raw(_ATTRIBUTE)}, 0)"
_QUOTED = "trim(BOTH ' \\t\\n\\r' FROM substr(q, instr(q, '=') + 1))"
_VALUE = f"translate(substr({_QUOTED}, 2, length({_QUOTED}) - 2), '\\t\\n\\r', '   ')"
_KEY = "trim(BOTH ' \\t\\n\\r' FROM substring_index(q, '=', 1))"
_NO_PAIRS = "cast(array() AS array<struct<k:string,v:string>>)"


def _token(kind: str, name: str, value: str, pairs: str = _NO_PAIRS, bad: str = "false") -> str:
    return f"named_struct('kind', {kind}, 'name', {name}, 'value', {value}, 'pairs', {pairs}, 'bad', {bad})"


_TARGET = f"regexp_extract(x, {_raw(f'^<[?]({_NAME})')}, 1)"
_READ = f"""
CASE WHEN startswith(x, '<!--') THEN {_token("'#'", "'#comment'", "substr(x, 5, length(x) - 7)", bad="contains(substr(x, 5, length(x) - 6), '--')")}
WHEN startswith(x, '<![CDATA[') THEN {_token("'c'", "'#cdata-section'", "substr(x, 10, length(x) - 12)")}
WHEN startswith(x, '<?') THEN {_token("'?'", _TARGET, f"ltrim(substr(x, length({_TARGET}) + 3, length(x) - length({_TARGET}) - 4))")}
WHEN startswith(x, '</') THEN {_token("'/'", f"regexp_extract(x, {_raw(f'^</({_NAME})')}, 1)", "''")}
WHEN startswith(x, '<') THEN {_token(
    "CASE WHEN endswith(x, '/>') THEN '-' ELSE 'e' END", f"regexp_extract(x, {_raw(f'^<({_NAME})')}, 1)", "''",
    f"transform({_PAIRS}, q -> named_struct('k', {_KEY}, 'v', {_decoded(_VALUE)}))",
    f"regexp_like(x, {_raw(_FOREIGN)}) OR size(array_distinct(transform({_PAIRS}, q -> {_KEY}))) < size({_PAIRS})")}
ELSE {_token("'t'", "'#text'", _decoded("x"), bad=f"regexp_like(x, {_raw(_FOREIGN)}) OR contains(x, ']]>')")} END
"""
_UP, _ABOVE = "concat(a.up, array(a.i))", "concat(a.names, array(x.name))"


def _node(kind: str, up: str, names: str, name: str, value: str) -> str:
    return f"named_struct('kind', {kind}, 'id', a.i, 'up', {up}, 'names', {names}, 'name', {name}, 'value', {value})"


_MADE = f"""
CASE WHEN x.kind IN ('e', '-') THEN concat(array({_node("'e'", _UP, _ABOVE, "x.name", "''")}), transform(x.pairs, p -> {_node("'@'", _UP, _ABOVE, "p.k", "p.v")}))
WHEN x.kind = '/' OR x.kind = '?' AND lower(x.name) = 'xml' THEN array()
ELSE array({_node("x.kind", "a.up", "a.names", "x.name", "x.value")}) END
"""
# nodes gather in blocks, so that no long array is copied for each token
_NODES = f"""
get(transform(array(regexp_extract_all(TEXT, {_raw(_TOKEN)}, 0)), tokens -> CASE WHEN length(array_join(tokens, '')) = length(TEXT) THEN
aggregate(transform(tokens, x -> {_READ}),
  named_struct('i', 1, 'up', array(0), 'names', array(''), 'bad', false, 'roots', 0, 'block', cast(array() AS array<{_NODE}>), 'blocks', cast(array() AS array<array<{_NODE}>>)),
  (a, x) -> named_struct(
    'i', a.i + 1,
    'up', CASE x.kind WHEN 'e' THEN {_UP} WHEN '/' THEN slice(a.up, 1, greatest(1, size(a.up) - 1)) ELSE a.up END,
    'names', CASE x.kind WHEN 'e' THEN {_ABOVE} WHEN '/' THEN slice(a.names, 1, greatest(1, size(a.names) - 1)) ELSE a.names END,
    'bad', a.bad OR x.bad
      OR x.kind = '/' AND (size(a.up) < 2 OR element_at(a.names, -1) <> x.name)
      OR size(a.up) = 1 AND (x.kind = 'c' OR x.kind = 't' AND trim(BOTH ' \t\n\r' FROM x.value) <> '')
      OR x.kind = '?' AND lower(x.name) = 'xml' AND a.i > 1,
    'roots', a.roots + CASE WHEN size(a.up) = 1 AND x.kind IN ('e', '-') THEN 1 ELSE 0 END,
    'block', CASE WHEN size(a.block) < 64 THEN concat(a.block, {_MADE}) ELSE array() END,
    'blocks', CASE WHEN size(a.block) < 64 THEN a.blocks ELSE concat(a.blocks, array(concat(a.block, {_MADE}))) END),
  a -> CASE WHEN NOT a.bad AND a.roots = 1 AND size(a.up) = 1 THEN flatten(concat(a.blocks, array(a.block))) END)
END), 0)
"""


def xml_nodes(column: str) -> Column:
    """The nodes of the XML text in ``column``, in document order; NULL for empty or malformed text.

    ``kind`` is e (element), @ (attribute), t (text), c (character data), # (comment) or ? (instruction). ``up`` has the
    ids of the elements above, from the document (0) down to an element itself; ``names`` goes with it. Document types
    and entities of their own, which could expand without bound, count as malformed. Keep it as a column when several
    paths are read.
    """
    text = f"trim(BOTH ' \\t\\n\\r' FROM `{column}`)"
    return F.expr(_NODES.replace("TEXT", text))


def well_formed(column: str) -> Column:
    """False for empty or malformed text."""
    return xml_nodes(column).isNotNull()


_STEP = re.compile(
    r"(?P<sep>//?)(?:(?P<text>text\(\))|@(?P<attr>[^/\[\]]+)|(?P<name>\*|[^/\[\]@()]+)(?P<tests>(?:\[[^\]]*\])*))"
)
_TEST = re.compile(r"\[(?:(?P<nth>\d+)|@(?P<attr>[^=\]]+)=(?P<quote>['\"])(?P<value>.*?)(?P=quote))\]")


def _steps(path: str) -> list[dict]:
    """``/a[1]//b[@k='v']/text()`` as steps; a path may hold child and descendant steps, positions and attribute tests."""
    steps, at = [], 0
    path = path if path.startswith("/") else f"/{path}"
    while at < len(path):
        m = _STEP.match(path, at)
        tests = [t.groupdict() for t in _TEST.finditer(m["tests"] or "")] if m else []
        if not m or "".join(t.group(0) for t in _TEST.finditer(m["tests"] or "")) != (m["tests"] or ""):
            raise ValueError(f"unsupported XML path: {path}")
        steps.append({**m.groupdict(), "tests": tests})
        at = m.end()
    return steps


def _last(array: Column, back: int = 1) -> Column:
    return F.get(array, F.size(array) - back)


def _is(node: Column, kind: str, name: str | None) -> Column:
    own = node["kind"] == kind
    return own if name in (None, "*") else own & (node["name"] == name)


def _step(nodes: Column, found: Column | None, step: dict) -> Column:
    """The nodes that one step reaches from ``found`` (the document at first)."""
    ids = F.array(F.lit(0)) if found is None else F.transform(found, lambda n: n["id"])
    deep = step["sep"] == "//"

    def reached(ids: Column) -> Column:
        if step["name"]:

            def hit(n: Column) -> Column:
                above = F.arrays_overlap(F.slice(n["up"], F.lit(1), F.size(n["up"]) - 1), ids) if deep else F.array_contains(ids, _last(n["up"], 2))
                return _is(n, "e", step["name"]) & above

        else:

            def hit(n: Column) -> Column:
                kind = _is(n, "@", step["attr"]) if step["attr"] else n["kind"].isin("t", "c")
                return kind & (F.arrays_overlap(n["up"], ids) if deep else F.array_contains(ids, _last(n["up"])))

        return F.filter(nodes, hit)

    out = let(ids, reached)
    for test in step["tests"]:
        out = let(out, _tested(nodes, test))
    return out


def _tested(nodes: Column, test: dict):
    """Function of selected elements: those at a position among the selected ones of their parent, or with an attribute."""

    def nth(sel: Column) -> Column:
        def at(n: Column) -> Column:
            before = F.filter(sel, lambda m: (_last(m["up"], 2) == _last(n["up"], 2)) & (m["id"] <= n["id"]))
            return F.size(before) == int(test["nth"])

        return F.filter(sel, at)

    def having(sel: Column) -> Column:
        return F.filter(
            sel, lambda n: F.exists(nodes, lambda m: _is(m, "@", test["attr"]) & (m["id"] == n["id"]) & (m["value"] == test["value"]))
        )

    return nth if test["nth"] else having


def select(nodes: Column, path: str) -> Column:
    """The nodes of :func:`xml_nodes` that a path selects, in document order."""
    return reduce(lambda found, step: _step(nodes, found, step), _steps(path), None)


def _trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\n\r"))


def xml_value(nodes: Column, path: str) -> Column:
    """Trimmed text of the last node that a path to texts or attributes selects; NULL when none or empty."""
    return F.nullif(_trimmed(F.try_element_at(select(nodes, path), F.lit(-1))["value"]), F.lit(""))


def xml_values(target: str, paths: dict[str, str]):
    """Step that writes the value of each path to its column; malformed XML changes nothing."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        df = df.withColumn("_text", masked(when, optional(df, target))).withColumn("_xml", xml_nodes("_text"))
        df = df.withColumns({f"_xml_{i}": xml_value(F.col("_xml"), path) for i, path in enumerate(paths.values())})
        for i, name in enumerate(paths):
            df = put(df, {name: F.col(f"_xml_{i}")}, F.col(f"_xml_{i}").isNotNull())
        return df.drop("_text", "_xml", *[f"_xml_{i}" for i in range(len(paths))])

    return step


def _entry(k: Column, v: Column) -> Column:
    return F.struct(k.alias("k"), v.alias("v"))


def _entries(nodes: Column, top: Column, max_level: int) -> Column:
    """(key, text) entries of a selected node and of what lies below it, with fewer than ``max_level`` names above."""
    depth = F.size(top["up"]) - 1

    def above(n: Column, less: int) -> Column:
        return F.slice(n["names"], depth + 1, F.greatest(F.lit(0), F.size(n["names"]) - depth - less))

    def key(n: Column) -> Column:
        names = F.array_join(above(n, 0), "-")
        return (
            F.when(n["kind"] == "@", F.concat(F.array_join(above(n, 1), "-"), F.lit("#"), n["name"]))
            .when(n["kind"] == "t", names)
            .when(n["name"].startswith("#"), F.concat(names, n["name"]))
            .otherwise(F.concat_ws("-", F.nullif(names, F.lit("")), n["name"]))
        )

    def kept(n: Column) -> Column:
        level = F.size(n["names"]) - depth - F.when(n["kind"] == "@", 1).otherwise(0)
        return (n["kind"] != "e") & (F.get(n["up"], depth) == top["id"]) & (level < max_level) & ((n["kind"] == "@") | (_trimmed(n["value"]) != ""))

    below = F.transform(F.filter(nodes, kept), lambda n: _entry(key(n), F.when(n["kind"] == "@", n["value"]).otherwise(_trimmed(n["value"]))))
    name = F.when(top["kind"] == "t", "").otherwise(top["name"])
    alone = F.filter(F.array(_entry(name, _trimmed(top["value"]))), lambda e: e["v"] != "")
    return F.when(top["kind"] == "e", below).otherwise(alone)


def flat_nodes(nodes: Column, paths: Sequence[str], max_level: int = 10) -> Column:
    found = F.concat(*[F.flatten(F.transform(select(nodes, p), lambda top: _entries(nodes, top, max_level))) for p in paths])
    return F.when(nodes.isNotNull(), last_wins_map(found))


def xml_flatten(column: str, paths: Sequence[str], max_level: int = 10) -> Column:
    """``map<string,string>`` of the texts and attributes below the paths; NULL for malformed XML.

    A text is keyed by the element names down to its own joined by ``-``, an attribute by the names of the *parent*
    elements followed by ``#attribute``. Of equal keys the last in document order wins.
    """
    return let(xml_nodes(column), lambda nodes: flat_nodes(nodes, paths, max_level))


def xml_fields(target: str, paths: Sequence[str], max_level: int = 10, output: str | None = None):
    """Step that writes the flattened XML of ``target`` to the map column ``<target>_xml``."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        name = output or f"{target}_xml"
        df = df.withColumn("_text", masked(when, optional(df, target))).withColumn("_nodes", xml_nodes("_text"))
        df = df.withColumn("_xml", flat_nodes(F.col("_nodes"), paths, max_level))
        return put(df, {name: F.col("_xml")}, F.col("_xml").isNotNull()).drop("_text", "_nodes", "_xml")

    return step
