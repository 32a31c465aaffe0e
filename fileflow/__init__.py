"""fileflow: folders of CSV / Excel files -> clean, validated, queryable tables, on Spark.

Sub-packages:
  sources/    discovery, profiling, CSV / workbook readers, landing, silver, JDBC, export
  functions/  column expressions (strings, dates, hashes, paths)
  operators/  cleaning, contracts, upsert, snapshot tables, catalog, records, runs, quality
  plans/      composed jobs (extract, transform + load, full run with quality gate)
  streaming/  incremental file ingest (Structured Streaming, availableNow)
"""

from fileflow.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
