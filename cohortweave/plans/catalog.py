"""All registered queries: each one runs an operator over whole given tables.

``QUERIES`` maps a name to a function of session and folder. ``ORACLES`` holds the
same result in SQL wherever SQL can state it.
"""

from cohortweave.plans import (  # noqa: F401  (each module registers its queries)
    catalog_evidence,
    catalog_features,
    catalog_jobs,
    catalog_modeling,
    catalog_sources,
    catalog_tables,
)
from cohortweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
