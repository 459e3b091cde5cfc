"""Incremental processing of station files as they land."""
