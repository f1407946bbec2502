"""Driver queries: the library's operators over the given tables, each with its SQL twin."""

from accrual.queries import documents, gold, growing, merges, model, profiles, storage  # noqa: F401
from accrual.queries.registry import callables, oracles

__all__ = ["callables", "oracles"]
