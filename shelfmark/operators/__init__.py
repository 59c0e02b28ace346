"""DataFrame operators: the catalog's relational core."""
