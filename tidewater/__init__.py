"""Change-data analytics on Spark: CDC, window metrics, lakehouse tables, quality and serving."""
