"""Reusable DataFrame operators: data tests, top-N + Others, dense global row
numbers, settings table, the metric layer, data generation, one-row combine."""
