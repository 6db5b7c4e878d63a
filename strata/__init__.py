"""strata — medallion (bronze → silver → gold) analytics as Spark DataFrame plans.

Sub-packages:
  functions  column → Column cleaning/parsing helpers (all built-in expressions)
  operators  DataFrame → DataFrame building blocks (dedup, joins, checks, snapshot, extension)
  sources    CSV / Parquet / table readers and writers
  plans      the layer models, the cleaning job and the end-to-end pipeline
  streaming  empty: the reference has no stream processing (loads are full replacements)
"""

__version__ = "0.1.0"
