"""All registered queries and their oracle SQL, collected from the plan modules."""

from __future__ import annotations

import importlib

PLAN_MODULES = ["trips", "topics", "text", "risk", "recommend", "classify", "clusters"]


def _modules():
    return [importlib.import_module(f"tabulon.plans.{m}") for m in PLAN_MODULES]


def queries() -> dict:
    out = {}
    for m in _modules():
        for k, v in m.QUERIES.items():
            assert k not in out, f"duplicate query key {k}"
            out[k] = v
    return out


def oracle_sql() -> dict:
    out = {}
    for m in _modules():
        out.update({k: v for k, v in m.oracle().items() if v})
    return out
