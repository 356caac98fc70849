from tessera.plans.catalog import PARAMS, QUERIES
from tessera.plans.oracle import SQL

__all__ = ["PARAMS", "QUERIES", "SQL"]
