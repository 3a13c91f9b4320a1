"""Named queries over the given tables, each with its SQL counterpart where one exists."""

from . import clustering, evaluation, jobs, relational, sources, state, text, training, vectors  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
