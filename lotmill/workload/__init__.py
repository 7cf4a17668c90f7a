"""Registered queries over the driver tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from lotmill.workload.registry import ORACLES, QUERIES

from lotmill.workload import cleaning, evaluation, features, modelling, pages, profiling, scalars, validation  # noqa: E402,F401  isort:skip

__all__ = ["ORACLES", "QUERIES"]
