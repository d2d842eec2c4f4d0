"""funnelspark: product-funnel and pilot analytics on an event log, as Spark
DataFrame plans.

Modules:
  sources    event-export scan, test-data adapter, pilot calendar, landing/tables
  functions  null-aware predicates, label formatting, text normalisation
  operators  lookups, reshapes, windows, top-N, exact quantiles, keyed sampling
  plans      period/pilot annotation and the report / dashboard metric tables
  streaming  incremental ingestion of export files into the landing table
"""

from .config import Params, Pilot  # noqa: F401

__all__ = ["Params", "Pilot"]
