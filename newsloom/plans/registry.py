"""Every query of the library with its SQL."""

from __future__ import annotations

from newsloom.plans import backfills, marts, monitoring, names, pages, payloads, people, reading, repairs, resolving, serving, sidebar, streams, views

PLANS = [marts, monitoring, resolving, reading, serving, views, repairs, pages, people, streams, sidebar, names, payloads, backfills]


def queries() -> dict:
    return {name: f for plan in PLANS for name, f in plan.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for plan in PLANS for name, sql in plan.SQL.items()}
