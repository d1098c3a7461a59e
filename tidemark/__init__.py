"""tidemark: market + text-sentiment analytics as Spark DataFrame plans.

Layout:
  functions/  Column -> Column expressions (text cleaning, dates, arrays, conditionals)
  operators/  DataFrame -> DataFrame operators (keywords, rollups, series windows, joins, ...)
  sources/    readers and writers for the landed file formats
  plans/      bindings onto the driver tables, composed queries, query registry
  streaming/  Structured Streaming versions of the incremental steps
"""

__version__ = "0.1.0"
