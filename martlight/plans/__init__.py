"""Composed jobs: the order marts and their data tests, the usage report and
its rendering, the sales metric model, and the registered queries."""
