"""Scalar rules as column expressions; no Python UDFs."""
