"""Test-data fixtures and the registry of runnable queries with their SQL oracles."""
