"""Registered queries, one module per group of operators."""

from recordloom.plans.queries import (  # noqa: F401
    drifting,
    fanning,
    flattening,
    joining,
    reporting,
    scanning,
    syncing,
    upserting,
)
