"""fleetlens: fleet-health analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers for CSV drops, tables, static reference frames
functions  column-expression builders (rules, trace ids, scores)
operators  reusable relational operators (as-of join, rolling windows,
           quality checks, aggregates, sampling)
plans      the derived tables of the pipeline and the dashboard queries
sinks      overwrite / append / keyed upsert / feature registration
streaming  incremental file ingest with Structured Streaming
ml         Spark ML training, registry and batch scoring
"""

__version__ = "0.1.0"
