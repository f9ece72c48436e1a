"""All queries, and the SQL that checks them."""

from __future__ import annotations

from tablex.plans import extracts, profiles, reconciliation, relational, sinks, types

MODULES = (extracts, types, sinks, profiles, reconciliation, relational)

QUERIES = {name: run for module in MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
