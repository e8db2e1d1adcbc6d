"""Registered queries and their DuckDB SQL."""

from __future__ import annotations


def _modules():
    from driftglass.catalog import lakehouse, streams, telemetry

    return (telemetry, lakehouse, streams)


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: v for m in _modules() for k, v in m.ORACLES.items()}
