"""cardrisk: a Spark-native card-transaction lakehouse.

Bronze (raw JSON with lineage) -> Silver (valid amounts, masked cards) ->
Gold (daily per-user risk profile), with reports, data-quality checks,
generators and partition-scoped table maintenance, all as DataFrame / Spark
SQL expressions.
"""

__version__ = "0.1.0"
