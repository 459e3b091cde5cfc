"""Readers and writers: station archives, station folders, Parquet tables."""
