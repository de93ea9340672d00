"""Query plans over the driver tables, registered by name."""

from tabletrust.plans import (  # noqa: F401  (imports register queries)
    q_compare,
    q_contracts,
    q_dump,
    q_runstate,
    q_state,
    q_stream,
    q_text,
)
from tabletrust.plans.catalog import REGISTRY, Query, Tables

__all__ = ["REGISTRY", "Query", "Tables"]
