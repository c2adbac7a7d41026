"""Scans and sinks: catalogues, granule listings, fields, binary records and metadata tables."""
