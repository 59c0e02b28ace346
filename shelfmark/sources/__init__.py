"""Readers: inventories, record files, scene files, earlier catalogs."""
