"""riskframe: transaction-risk analytics as Spark DataFrame operators.

Every public operator takes and returns ``pyspark.sql.DataFrame`` objects
(or column expressions), so Catalyst sees one declarative plan end to end.
"""

__version__ = "0.1.0"
