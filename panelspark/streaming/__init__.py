"""Streaming use.

There is no streaming operator of its own: the workload is batch only. The row-wise
functions (`panelspark.operators.features`: features, fills along a row, normalisation,
signatures) are stateless projections and accept a streaming DataFrame as it is, for example
``add_features(spark.readStream.schema(panel_schema()).parquet(path)).writeStream...``.
"""
