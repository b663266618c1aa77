"""driftwood: telemetry, call-record and data-quality operators on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
functions, so Catalyst plans it; where the semantics allow, the same function
runs on batch tables and on Structured Streaming frames.
"""

__version__ = "0.1.0"
