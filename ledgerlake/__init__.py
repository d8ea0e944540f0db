"""Payment-fraud lakehouse and Spark-workload analytics on plain PySpark."""
