"""Catalogs over very large object archives, as Spark jobs.

An inventory of stored objects and a large body of JSON records become three related tables
(files, metadata, linkages) that are checked by gates and published in a safe order.
"""

from shelfmark.spec import CatalogSpec

__all__ = ["CatalogSpec"]
