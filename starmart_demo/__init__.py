"""The library at work on the benchmark tables: every query with its SQL counterpart."""

from starmart_demo import cleaning, files, keys, profiling, quality, star  # noqa: F401
from starmart_demo.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
