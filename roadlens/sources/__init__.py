"""Readers and writers of period tables, lookups, demand and snapshots."""
