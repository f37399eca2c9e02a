"""All registered queries of the engine and the SQL that gives the same rows."""

from __future__ import annotations

from tidewater.plans import queries_batch, queries_serving, queries_streams, queries_tables

QUERIES = {**queries_batch.QUERIES, **queries_serving.QUERIES, **queries_streams.QUERIES, **queries_tables.QUERIES}
ORACLES = {**queries_batch.ORACLES, **queries_serving.ORACLES, **queries_streams.ORACLES, **queries_tables.ORACLES}
