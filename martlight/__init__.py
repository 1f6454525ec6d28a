"""martlight: dimensional marts, metered-usage reporting and a small metric
layer, written as PySpark DataFrame plans.

Sub-packages:
  sources    table readers and the logical-table bindings over the testdata
  functions  Column helpers (service family, labels, number/date formatting)
  operators  reusable DataFrame operators (top-N + Others, data tests,
             settings, semantic model, data generation)
  plans      the composed jobs (TPC-H marts, usage report, sales metrics)
  streaming  incremental maintenance of the daily usage ledger rollup
"""

__version__ = "0.1.0"
