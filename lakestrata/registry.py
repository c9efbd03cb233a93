"""All registered queries (importing the catalog modules registers them)."""

from lakestrata import catalog, catalog_core, catalog_io, catalog_quality  # noqa: F401
from lakestrata.catalog import REGISTRY

__all__ = ["REGISTRY"]
