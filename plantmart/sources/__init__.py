"""Landed-zone discovery, routing, delimited scans and the raw zone."""
