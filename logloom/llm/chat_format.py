"""Chat formatting by schema fingerprint.

A record is a struct whose fields are filled by layout: prompts, instructions or message lists, as one gets from
reading mixed JSON files. The nested paths that are filled in a record, sorted and hashed, are its fingerprint; it
selects a declarative mapping to canonical turns. A template marks the turns; control strings inside a role or a
text are escaped, so the formatted string can be read back exactly.

Only DataFrame functions are used. Defined cases: a null text or role is empty; a record whose fingerprint has no
mapping keeps ``layout``, ``turns`` and ``formatted`` null; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


@dataclass(frozen=True)
class Layout:
    """``turns``: (role, path) in order, or ``items``: (list, role field, text field). ``optional`` paths may be unfilled."""

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    items: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)

    def fingerprints(self) -> list[str]:
        if self.items:
            top, role, text = self.items
            paths = [top, f"{top}[].{role}", f"{top}[].{text}"]
        else:
            paths = [p for _, p in self.turns]
        fixed = [p for p in paths if p not in self.optional]
        return [_hash([*fixed, *some]) for n in range(len(self.optional) + 1) for some in combinations(self.optional, n)]


def _hash(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


LAYOUTS = (
    Layout("prompt", turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", turns=(("system", "system"), ("user", "instruction"), ("assistant", "output")), optional=("system",)),
    Layout("messages", items=("messages", "role", "content")),
    Layout("shared", items=("conversations", "from", "value"), roles={"human": "user", "gpt": "assistant"}),
)


def _holds(name: str):
    return lambda item: item[name].isNotNull()


def _filled(value: Column, kind: DataType, path: str) -> list[Column]:
    """Paths at or below ``value`` that are filled, as nullable strings."""
    here = [F.when(value.isNotNull(), F.lit(path))] if path else []
    if isinstance(kind, StructType):
        return here + [c for f in kind for c in _filled(value[f.name], f.dataType, f"{path}.{f.name}".lstrip("."))]
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        return here + [F.when(F.exists(value, _holds(f.name)), F.lit(f"{path}[].{f.name}")) for f in kind.elementType]
    return here


def fingerprint(record: Column, kind: StructType) -> Column:
    """Hash of the sorted nested paths that are filled in ``record``."""
    return F.sha2(F.concat_ws("\n", F.array_sort(F.array_compact(F.array(*_filled(record, kind, ""))))), 256)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _role(value: Column, names: dict[str, str]) -> Column:
    return reduce(lambda out, kv: F.when(value == kv[0], F.lit(kv[1])).otherwise(out), names.items(), value)


def _apply(layout: Layout, record: Column, kind: StructType) -> Column | None:
    def get(path: str) -> Column:
        return reduce(lambda c, name: c[name], path.split("."), record)

    if layout.items:
        top, role, text = layout.items
        if top not in kind.names:
            return None
        return F.transform(get(top), lambda x: _turn(_role(x[role], layout.roles), x[text]))
    if any(p.split(".")[0] not in kind.names for _, p in layout.turns if p not in layout.optional):
        return None
    turns = [F.when(get(p).isNotNull() | F.lit(p not in layout.optional), _turn(F.lit(r), get(p))) for r, p in layout.turns if p.split(".")[0] in kind.names]
    return F.array_compact(F.array(*turns))


def canonical(df: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` with ``fingerprint``, ``layout`` and ``turns`` (role, text) of the struct column ``record``."""
    kind = df.schema[record].dataType
    df = df.withColumn("fingerprint", fingerprint(F.col(record), kind))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        made = _apply(layout, F.col(record), kind)
        if made is not None:
            hit = F.col("fingerprint").isin(layout.fingerprints())
            name, turns = F.when(hit, F.lit(layout.name)).otherwise(name), F.when(hit, made).otherwise(turns)
    return df.withColumns({"layout": name, "turns": turns})


def escape(text: Column) -> Column:
    r"""Control strings all start with ``<|``: it becomes ``<\|``, and a backslash is doubled."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(df: DataFrame, turns: str = "turns", learn: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans``: [start, end) in code points of the texts of role ``learn``."""
    head = lambda t: F.concat(F.lit(START), escape(t["role"]), F.lit(MIDDLE))
    parts = F.transform(turns, lambda t: F.struct(head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == learn).alias("learn")))
    df = df.withColumn("__parts", parts)
    df = df.withColumn("formatted", F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), ""))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)").alias("spans"))

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct((end + len(END) + 1).cast("long").alias("at"), F.when(p["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return df.withColumn("loss_spans", F.aggregate("__parts", empty, step, lambda s: s["spans"])).drop("__parts")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string."""
    turns = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def turn(part: Column) -> Column:
        halves = F.split(part, r"<\|im_sep\|>")
        body = halves[1].substr(F.lit(1), F.length(halves[1]) - len(END) - 1)
        return F.struct(unescape(halves[0]).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, turn)


def under_mask(formatted: Column, spans: Column) -> Column:
    """All text under the loss spans, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def records_of_turns(rows: DataFrame) -> DataFrame:
    """One record a conversation from rows (conv_id, turn, role, text), in the tightest layout that holds it.

    Turns are ordered by (turn, role, text). A conversation is one record, so its turns meet in one row.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    convs = rows.groupBy("conv_id").agg(turns.alias("__turns"))
    roles = F.concat_ws(",", F.transform("__turns", lambda t: F.replace(F.replace(t["role"], F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,"))))
    text = lambda i: F.get("__turns", F.lit(i))["text"]
    pair, triple = roles == "user,assistant", roles == "system,user,assistant"
    named = F.forall("__turns", lambda t: t["role"].isin("user", "assistant"))
    shared = named & ~pair
    alias = lambda t: F.when(t["role"] == "user", "human").otherwise("gpt")
    record = F.struct(
        F.when(pair, text(0)).alias("prompt"),
        F.when(pair, text(1)).alias("completion"),
        F.when(triple, text(0)).alias("system"),
        F.when(triple, text(1)).alias("instruction"),
        F.when(triple, text(2)).alias("output"),
        F.when(shared, F.transform("__turns", lambda t: F.struct(alias(t).alias("from"), t["text"].alias("value")))).alias("conversations"),
        F.when(~(pair | triple | shared), F.transform("__turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))).alias("messages"),
    )
    return convs.select("conv_id", record.alias("record"))
