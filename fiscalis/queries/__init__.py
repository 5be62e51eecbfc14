"""Registered queries of the audit engine and their SQL."""

from __future__ import annotations

from fiscalis.queries import dashboard, joins, landing, records, rules, scalars, state

QUERIES = scalars.QUERIES | rules.QUERIES | landing.QUERIES | dashboard.QUERIES | records.QUERIES | joins.QUERIES | state.QUERIES
SQL = scalars.SQL | rules.SQL | landing.SQL | dashboard.SQL | records.SQL | joins.SQL | state.SQL
