"""cohortlens: customer-segmentation analytics as Spark DataFrame and Spark ML jobs.

Layers:
  functions/  Column-returning scalar helpers (safe parsing, NPS class, dates, winsorise)
  sources/    CSV / JDBC readers and writers with fixed schemas
  operators/  DataFrame-in / DataFrame-out operators (relational, mapping, quality,
              features, preprocessing, clustering)
  plans/      composite jobs and the query registry used by the oracle checks
  streaming/  incremental file ingest of the same mapping operator
"""

__version__ = "0.1.0"
