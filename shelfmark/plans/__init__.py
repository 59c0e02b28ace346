"""End-to-end steps built from the operators; each reads and writes tables, so each can be rerun."""
