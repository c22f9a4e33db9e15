"""All registered queries."""

from __future__ import annotations

from importlib import import_module

MODULES = ["retail", "exercises", "delivery", "clearance", "arrears", "collections", "ledgers", "streams", "modeling"]


def registries():
    return [import_module(f"ledgerloom.plans.{m}").R for m in MODULES]


def all_queries() -> dict:
    out: dict = {}
    for r in registries():
        clash = out.keys() & r.queries.keys()
        if clash:
            raise ValueError(f"queries registered twice: {sorted(clash)}")
        out.update(r.queries)
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for r in registries():
        out.update(r.oracles)
    return out
