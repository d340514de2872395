"""The registered queries, each next to the SQL that must give the same rows."""

from . import (  # noqa: F401
    aggregation,
    cleaning,
    cells,
    checks,
    composites,
    joining,
    learning,
    modelling,
    projecting,
    properties,
    scoring,
    series,
)
from .base import REGISTRY

__all__ = ["REGISTRY"]
