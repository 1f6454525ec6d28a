"""Inputs and outputs: parquet table access, typed schemas and writes, and the
logical tables bound onto the testdata."""
