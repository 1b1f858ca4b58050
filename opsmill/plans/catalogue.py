"""All registered queries and oracles by name."""

from __future__ import annotations

from functools import partial

from opsmill.plans import etl_queries, lookup_queries, policy_queries, text_queries  # noqa: F401  (register)
from opsmill.plans.registry import QUERIES, oracle, run

QUERIES_BY_NAME = {name: partial(run, name) for name in QUERIES}
ORACLES = {name: sql for name in QUERIES if (sql := oracle(name)) is not None}
