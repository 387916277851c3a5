"""Import every query module so the registry is complete."""

from goldenrec.plans import (catalog, catalog_cleaning, catalog_distribution, catalog_entities,  # noqa: F401
                             catalog_profile, catalog_quality, catalog_sources)
from goldenrec.plans import catalog_ingest, catalog_linkage, catalog_streaming  # noqa: F401,E402  (reuse batch oracles)
from goldenrec.plans.registry import ORACLE, QUERIES  # noqa: F401
