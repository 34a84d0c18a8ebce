"""Row predicates. Each returns a non-null boolean Column, so AND and NOT are plain."""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.cols import field, nz

_COMPARE = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le}


def exist(key: str) -> Column:
    return field(key).isNotNull()


def not_exist(key: str) -> Column:
    return field(key).isNull()


def equal(key: str, value: str) -> Column:
    return nz(field(key)) == F.lit(value)


def not_equal(key: str, value: str) -> Column:
    return nz(field(key)) != F.lit(value)


def whole_match(c: Column, regex: str) -> Column:
    return F.coalesce(c.rlike(rf"\A(?:{regex})\z"), F.lit(False))


def match(key: str, regex: str) -> Column:
    """Whole-text regex match; an absent field never matches."""
    return whole_match(field(key), regex)


contain = match


def not_match(key: str, regex: str) -> Column:
    return ~match(key, regex)


def find(key: str, regex: str) -> Column:
    """Regex search anywhere in the text; an absent field counts as empty text."""
    return nz(field(key)).rlike(regex)


def not_find(key: str, regex: str) -> Column:
    return ~find(key, regex)


def math(key: str, op: str, value: float) -> Column:
    number = field(key).try_cast("double")
    return F.coalesce(_COMPARE[op](number, F.lit(float(value))), F.lit(False))


def always() -> Column:
    return F.lit(True)


def never() -> Column:
    return F.lit(False)


def all_of(*conditions: Column) -> Column:
    """AND of a requirement list; an empty list is true."""
    return reduce(operator.and_, conditions, F.lit(True))


#: A condition text: a pool, a dot and a field, then nothing, a comparison sign with a value, or words.
_CONDITION = re.compile(
    r"\s*\w+\.(?P<key>[^\s=!<>]+)\s*"
    r"(?:(?P<sign>==|!=|>=|<=|=|>|<)\s*(?P<operand>.+?)"
    r"|(?P<verb>not match|match|contain|not find|find) (?P<regex>.+)"
    r"|(?P<state>not exist|exist)?)\s*"
)
_VERBS = {"match": match, "contain": contain, "not match": not_match, "find": find, "not find": not_find}
_STATES = {None: exist, "exist": exist, "not exist": not_exist}


def from_text(text: str) -> Column:
    """The predicate of a condition such as ``global.type match apache_.*``, ``fields.code >= 500`` or ``fields.agent``.

    Values follow a sign with or without blanks; a regex takes all that follows its word. The pool before the dot does not matter
    here, since all fields are columns. Unknown texts raise an error.
    """
    found = _CONDITION.fullmatch(text)
    if not found:
        raise ValueError(f"not a condition: {text}")
    key, sign, operand = found["key"], found["sign"], found["operand"]
    if sign in ("=", "=="):
        return equal(key, operand)
    if sign == "!=":
        return not_equal(key, operand)
    if sign:
        return math(key, sign, float(operand))
    if found["verb"]:
        return _VERBS[found["verb"]](key, found["regex"])
    return _STATES[found["state"]](key)


def field_of(text: str) -> str:
    """The field that a condition text reads."""
    found = _CONDITION.fullmatch(text)
    if not found:
        raise ValueError(f"not a condition: {text}")
    return found["key"]
