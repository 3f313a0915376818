"""Registered queries: a Spark builder and (where SQL can express it) the
equivalent DuckDB SQL for each operator of the inventory."""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Callable, str | None]]:
    from retenta.registry import (  # noqa: F401
        q_sources, q_features, q_state, q_split, q_publish, q_evaluate, q_profile, q_models, q_stream)
    return REGISTRY
