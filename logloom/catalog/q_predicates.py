"""Predicates, guarded steps and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.catalog import lines
from logloom.catalog.lines import with_events
from logloom.catalog.registry import query, table
from logloom.functions import predicates as p
from logloom.operators import mutate
from logloom.plans.steps import require, route

_MAIL = r"[a-z0-9.]+@[a-z0-9]+\.[a-z]+"

# name, predicate, condition in SQL; all over events with some bytes missing
_CASES = {
    "pred_exist": (lambda: p.exist("nbytes"), "nbytes IS NOT NULL"),
    "pred_not_exist": (lambda: p.not_exist("nbytes"), "nbytes IS NULL"),
    "pred_equal": (lambda: p.equal("nbytes", ""), "coalesce(nbytes, '') = ''"),
    "pred_not_equal": (lambda: p.not_equal("nbytes", "7"), "coalesce(nbytes, '') <> '7'"),
    "pred_match": (lambda: p.match("nbytes", r"1|2\d*"), r"coalesce(regexp_full_match(nbytes, '1|2\d*'), false)"),
    "pred_not_match": (lambda: p.not_match("nbytes", r"1|2\d*"), r"NOT coalesce(regexp_full_match(nbytes, '1|2\d*'), false)"),
    "pred_math": (
        lambda: p.math("nbytes", ">=", 20) & p.math("nbytes", "<", 300) | p.math("request", ">", 0),
        "coalesce(try_cast(nbytes AS double) >= 20 AND try_cast(nbytes AS double) < 300, false)",
    ),
    "pred_const": (lambda: p.always() & ~p.never(), "true"),
}
for _name, (_predicate, _sql) in _CASES.items():

    @query(_name, with_events(f"SELECT event_id, nbytes FROM ev WHERE {_sql}"))
    def _run(spark, sf_dir, predicate=_predicate):
        return lines.events(spark, sf_dir).filter(predicate()).select("event_id", "nbytes")

# condition texts, and the same in SQL
_TEXTS = {
    "fields.nbytes": "nbytes IS NOT NULL",
    "fields.nbytes exist": "nbytes IS NOT NULL",
    "fields.nbytes not exist": "nbytes IS NULL",
    "global.event_type == view": "event_type = 'view'",
    "global.event_type=view": "event_type = 'view'",
    "global.event_type != view": "event_type <> 'view'",
    r"fields.nbytes match 1|2\d*": r"coalesce(regexp_full_match(nbytes, '1|2\d*'), false)",
    r"fields.nbytes contain 1|2\d*": r"coalesce(regexp_full_match(nbytes, '1|2\d*'), false)",
    r"fields.nbytes not match 1|2\d*": r"NOT coalesce(regexp_full_match(nbytes, '1|2\d*'), false)",
    "fields.request find uid=1": "contains(request, 'uid=1')",
    "fields.request not find uid=1": "NOT contains(request, 'uid=1')",
    "fields.nbytes > 20": "coalesce(try_cast(nbytes AS double) > 20, false)",
    "fields.nbytes<20": "coalesce(try_cast(nbytes AS double) < 20, false)",
    "fields.nbytes >= 20": "coalesce(try_cast(nbytes AS double) >= 20, false)",
    "fields.nbytes <= 20.5": "coalesce(try_cast(nbytes AS double) <= 20.5, false)",
}


@query("pred_from_text", with_events("SELECT event_id, " + ", ".join(f"{sql} AS c{i}" for i, sql in enumerate(_TEXTS.values())) + " FROM ev"))
def pred_from_text(spark, sf_dir):
    """Condition texts of configurations, one column each."""
    return lines.events(spark, sf_dir).select("event_id", *[p.from_text(t).alias(f"c{i}") for i, t in enumerate(_TEXTS)])


@query("pred_find", f"SELECT doc_id, n_chars FROM documents WHERE regexp_matches(coalesce(text, ''), '{_MAIL}')")
def pred_find(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(p.find("text", _MAIL)).select("doc_id", "n_chars")


@query("pred_not_find", f"SELECT doc_id, n_chars FROM documents WHERE NOT regexp_matches(coalesce(text, ''), '{_MAIL}')")
def pred_not_find(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(p.not_find("text", _MAIL)).select("doc_id", "n_chars")


@query(
    "step_guarded",
    with_events(
        "SELECT event_id, CASE WHEN event_type = 'error' AND nbytes IS NOT NULL THEN 'page' ELSE verb END AS verb, "
        "CASE WHEN event_type = 'error' AND nbytes IS NOT NULL AND user_id % 2 = 0 THEN 'even' END AS note FROM ev"
    ),
)
def step_guarded(spark, sf_dir):
    ev = lines.events(spark, sf_dir).withColumn("odd", (F.col("user_id") % 2).cast("string"))
    ev = require(mutate.insert("verb", "page"), p.equal("event_type", "error"), p.exist("nbytes"))(ev)
    # the second step sees what the first one wrote
    ev = require(mutate.create("note", "even"), p.equal("verb", "page"), p.equal("odd", "0"), fields=["note"])(ev)
    return ev.select("event_id", "verb", "note")


@query(
    "route_by_type",
    with_events(
        "SELECT event_id, event_type AS type, CASE WHEN token = 'u7' AND event_type = 'click' THEN 'own click' "
        "WHEN event_type = 'click' THEN 'click' WHEN event_type = 'error' THEN 'error' END AS handled, "
        "CASE WHEN event_type = 'error' THEN concat('/', status) END AS code FROM ev"
    ),
)
def route_by_type(spark, sf_dir):
    ev = lines.events(spark, sf_dir).withColumn("type", F.col("event_type"))
    table_ = {
        "*": {
            "click": [mutate.insert("handled", "click")],
            "error": [mutate.insert("handled", "error"), mutate.insert_from("code", "status"), mutate.replace("code", "^", "/")],
        },
        "u7": {"click": [mutate.insert("handled", "own click")]},
    }
    return route(ev, table_).select("event_id", "type", "handled", "code")
