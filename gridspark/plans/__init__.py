"""Contract queries: the operators applied to the given tables, with their SQL twins."""

from gridspark.plans import coverage, generation, landing, market, merging, reading, stores, supply, weather  # noqa: F401
from gridspark.plans.registry import PLANS

__all__ = ["PLANS"]
