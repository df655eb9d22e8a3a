"""ledgerloom — revenue reconciliation and anomaly analytics on Spark.

Every operator is a function from DataFrames to a DataFrame built from
Spark's own relational operators (joins, aggregates, windows), so Catalyst
plans the work and it scales with the cluster.
"""

__version__ = "0.1.0"
