"""tidemark: dated price / rate series analytics on Spark.

Public API is a set of ``DataFrame -> DataFrame`` functions over the raw rates schema
(``tidemark.schema.RAW_COLUMNS``) plus a few jobs that read and write parquet tables.
"""

from tidemark.schema import RAW_SCHEMA, SeriesSpec, to_raw

__all__ = ["RAW_SCHEMA", "SeriesSpec", "to_raw"]
