"""All registered queries of the library itself and their SQL twins."""

from __future__ import annotations

from drawloom.plans import assembly, change, knowledge, streams, structure

QUERIES: dict = {}
ORACLES: dict = {}
for module in (change, structure, knowledge, streams, assembly):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES

#: The names of queries that once read a part of their tables stand for the same over whole tables.
for name in ("g03_flow_between", "j09_as_of_join", "n10_service_texts", "o02_to_from", "q07_roundtrip"):
    QUERIES[name], ORACLES[name] = QUERIES[f"{name}_whole"], ORACLES[f"{name}_whole"]
