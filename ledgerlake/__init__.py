"""ledgerlake: a PySpark-native retail analytics engine.

Raw sales data flows through bronze (ingest + enrichment), silver (dedup,
cleaning, typing, derived measures) and gold (reporting marts), and a
declarative data-quality suite checks every layer. Every operator is a plain
``DataFrame -> DataFrame`` function built from Spark SQL expressions.
"""

__version__ = "0.1.0"
