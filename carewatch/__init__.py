"""carewatch: provider-accountability analytics expressed as Spark DataFrame plans.

Sub-packages:
  functions  - Column builders (number parsing, keys, flags, dates) and row predicates
  sources    - readers for landed CSV / JSON pages / Parquet, and sinks
  operators  - contracts, joins, set logic, aggregates, ranking, data-quality checks
  plans      - end-to-end table builds and the queries run against the test tables
  streaming  - resumable incremental ingest of landed page files
"""

__version__ = "0.1.0"
