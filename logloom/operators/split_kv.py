"""Regex split, key-value maps, and both with character positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import ALWAYS, last_wins_map, let, masked, optional, put, running_starts


def split_parts(c: Column, delimiter: str, limit: int = -1) -> Column:
    """Regex split; ``limit`` 0 drops trailing empty parts, as JVM split does."""
    parts = F.split(c, delimiter, limit)
    if limit != 0:
        return parts

    def trimmed(a: Column) -> Column:
        last = F.aggregate(a, F.struct(F.lit(0).alias("n"), F.lit(0).alias("i")), lambda s, x: F.struct(
            F.when(x != "", s["i"] + 1).otherwise(s["n"]).alias("n"), (s["i"] + 1).alias("i")))["n"]
        # empty text is one empty part
        return F.when(c == "", a).otherwise(F.slice(a, F.lit(1), last))

    return let(parts, trimmed)


def split(target: str, delimiter: str, limit: int = -1, names: Sequence[str] = ()):
    """Step that splits a field. Parts go to ``names``, the shorter list decides.

    Without names the parts form a map column ``<target>_parts`` keyed "0", "1", ...
    """

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        df = df.withColumn("_text", masked(when, F.nullif(optional(df, target), F.lit(""))))
        df = df.withColumn("_parts", split_parts(F.col("_text"), delimiter, limit))
        if names:
            for i, name in enumerate(names):
                df = put(df, {name: F.get(F.col("_parts"), F.lit(i))}, F.size(F.col("_parts")) > i)
        else:
            keyed = F.map_from_entries(
                F.transform(F.col("_parts"), lambda p, i: F.struct(i.cast("string"), p))
            )
            df = put(df, {f"{target}_parts": keyed}, F.col("_text").isNotNull())
        return df.drop("_text", "_parts")

    return step


def kv_pairs(c: Column, delimiter: str = r"\s+", sub_delimiter: str = "=") -> Column:
    """Map of ``key<sub>value`` words; words without sub-delimiter drop out, the last of a key wins."""
    if sub_delimiter == "":
        return F.lit(None).cast("map<string,string>")
    pairs = F.filter(
        F.transform(F.split(c, delimiter), lambda w: F.split(w, sub_delimiter, 2)), lambda p: F.size(p) == 2
    )
    entries = F.transform(pairs, lambda p: F.struct(p[0].alias("k"), p[1].alias("v")))
    return let(entries, lambda e: F.when(F.size(e) > 0, last_wins_map(e)))


def kv(target: str, delimiter: str = r"\s+", sub_delimiter: str = "=", prefix: str = "", keys: Sequence[str] = ()):
    """Step that writes ``<target>_map``; ``keys`` are also lifted to ``<prefix><key>`` columns."""

    def step(df: DataFrame, when: Column = ALWAYS) -> DataFrame:
        text = masked(when, F.nullif(optional(df, target), F.lit("")))
        df = df.withColumn("_kv", kv_pairs(text, delimiter, sub_delimiter))
        df = put(df, {f"{target}_map": F.col("_kv")}, F.col("_kv").isNotNull())
        for key in keys:
            value = F.element_at(F.col("_kv"), key)
            df = put(df, {prefix + key: value}, value.isNotNull())
        return df.drop("_kv")

    return step


def split_spans(c: Column, delimiter: str, max_split: int = -1) -> Column:
    """``array<struct<start,end,piece>>`` of a split done at most ``max_split`` times."""
    pieces = F.split(c, delimiter, max_split + 1 if max_split >= 0 else -1)
    gaps = F.regexp_extract_all(c, F.lit(delimiter), F.lit(0))

    def build(both: Column) -> Column:
        steps = F.transform(
            both["p"], lambda p, i: F.length(p) + F.coalesce(F.length(F.get(both["g"], i)), F.lit(0))
        )
        return let(
            running_starts(steps),
            lambda s: F.transform(
                both["p"],
                lambda p, i: F.struct(
                    F.get(s, i).alias("start"), (F.get(s, i) + F.length(p)).alias("end"), p.alias("piece")
                ),
            ),
        )

    return F.when(c.isNotNull(), let(F.struct(pieces.alias("p"), gaps.alias("g")), build))


def kv_spans(c: Column, delimiter: str, sub_delimiter: str) -> Column:
    """``array<struct<name,start,end,value>>`` of key-value words with the position of the value.

    The value ends at the next sub-delimiter. A word without one is its own name and value.
    """

    def of_word(w: Column) -> Column:
        def pick(parts: Column) -> Column:
            alone = F.size(parts) == 1
            value = F.when(alone, F.get(parts, F.lit(0))).otherwise(F.get(parts, F.lit(1)))
            return F.struct(
                F.get(parts, F.lit(0))["piece"].alias("name"),
                (w["start"] + value["start"]).alias("start"),
                (w["start"] + value["end"]).alias("end"),
                value["piece"].alias("value"),
            )

        return let(split_spans(w["piece"], sub_delimiter, 2), pick)

    words = F.filter(split_spans(c, delimiter), lambda w: w["piece"] != "")
    return F.transform(words, of_word)
