"""All queries of the core and the SQL they are held against."""

from __future__ import annotations

from tierflow.plans import corpus, exchange, timelines, training

QUERIES = {**corpus.QUERIES, **timelines.QUERIES, **training.QUERIES, **exchange.QUERIES}
ORACLE = {**corpus.ORACLE, **timelines.ORACLE, **training.ORACLE, **exchange.ORACLE}
