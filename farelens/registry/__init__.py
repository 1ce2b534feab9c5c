"""Every operator bound to the supplied tables, with the SQL it is checked against."""

from farelens.registry.base import REGISTRY, Entry  # noqa: F401
from farelens.registry import (  # noqa: F401  (each module registers its entries)
    extraction, preparation, indicators, series, elasticity, customers, fares, scenario,
)
