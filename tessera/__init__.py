"""tessera: fixed-width ingestion and personal-data masking on Spark.

Every operator takes and returns DataFrames and is built from native
``pyspark.sql.functions`` expressions, so Catalyst can prune, push down and
code-generate the whole plan. See README.md for the module map.
"""

__version__ = "0.1.0"
