"""moodwatch: public-opinion monitoring as Spark DataFrame jobs.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` so that one definition runs on batch tables and on
Structured Streaming.  Library code never creates a session or sets a master;
callers pass DataFrames (and, where a job needs storage, a SparkSession).
"""

__version__ = "0.1.0"
