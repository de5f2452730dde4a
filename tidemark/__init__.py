"""tidemark: report files to clean, typed, traceable tables on Spark.

Subpackages:
  functions  Column -> Column parsers and name rules (no Python UDFs)
  operators  DataFrame -> DataFrame operators (filters, joins, aggregates,
             reshape, nested documents, entity resolution, dictionaries,
             links, incremental selection)
  sources    file readers (CSV/TSV text, report matrices, sheets, JSON)
  sinks      slice replacement, schema evolution, upsert, comments
  plans      table recipes and the registered proof queries
  streaming  incremental file loading as a Structured Streaming job
"""

__version__ = "0.1.0"
