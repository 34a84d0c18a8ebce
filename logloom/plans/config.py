"""Configuration rows to routed steps.

One row is one step of a pipeline; the rows of a pipeline are few, so they are read on the driver while the plan is built.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from logloom.functions import predicates
from logloom.functions.cols import ALWAYS
from logloom.operators import mutate
from logloom.plans.shipped import STEP_TYPES
from logloom.plans.steps import Step, require, run

#: More rows than any set of pipelines needs; a larger table was not selected first.
MOST_ROWS = 100_000

MUTATIONS = {
    "create": mutate.create,
    "create_from": mutate.create_from,
    "insert": mutate.insert,
    "insert_from": mutate.insert_from,
    "rename": mutate.rename,
    "remove": mutate.remove,
    "arithmetic": mutate.arithmetic,
    "replace": mutate.replace,
    "replace_from": mutate.replace_from,
    "mark": mutate.mark,
}


def step_of(kind: str, target: str, argument: Mapping[str, Any], resources: Mapping[str, DataFrame]) -> Step:
    """The step of one row. ``argument`` holds the keyword arguments of its factory; ``resources`` gives tables by step type.

    ``mutate`` takes a list of ``[name, argument, ...]`` commands, run in order.
    """
    if kind == "mutate":
        commands = [MUTATIONS[name](*args) for name, *args in argument["commands"]]

        return lambda df, when=ALWAYS: run(df, commands, when)
    factory = STEP_TYPES[kind]
    if kind in resources:
        return factory(resources[kind], target, **argument)
    if kind in ("regex-based-anomaly-detection", "random-anomaly-detection"):
        return factory(**argument)
    return factory(target, **argument)


def steps_from_rows(rows: DataFrame, resources: Mapping[str, DataFrame] | None = None) -> dict[str, dict[str, Sequence[Step]]]:
    """``{token: {type: [step, ...]}}`` for :func:`logloom.plans.steps.route`.

    ``rows`` has token, record_type (as :func:`logloom.operators.refdata.config_by_type` gives it), orders, type, source_field,
    argument (a JSON object, or NULL) and requires (condition texts, or NULL). Steps run by (orders, name).
    """
    found = rows.select("token", "record_type", "orders", "name", "type", "source_field", "argument", "requires").limit(MOST_ROWS + 1).collect()
    if len(found) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} configuration rows; select the pipelines that are wanted first")
    table: dict[str, dict[str, list[Step]]] = {}
    for r in sorted(found, key=lambda r: (r.orders, r.name or "")):
        step = step_of(r.type, r.source_field, json.loads(r.argument or "{}"), resources or {})
        conditions = list(r.requires or [])
        if conditions:
            step = require(step, *map(predicates.from_text, conditions), fields=map(predicates.field_of, conditions))
        table.setdefault(r.token, {}).setdefault(r.record_type, []).append(step)
    return table
