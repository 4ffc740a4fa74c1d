"""Supply-requirements analytics on Spark.

DataFrame operators (``operators``), sources, sinks and contracts
(``sources``), column functions and null rules (``functions``), composite
jobs and the registered queries (``plans``) and a Structured Streaming
control flow (``streaming``). Every operator takes and returns a
``pyspark.sql.DataFrame``; nothing is collected to the driver.
"""

__all__ = ["functions", "operators", "plans", "session", "sources", "streaming"]
