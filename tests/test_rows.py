import datetime

import __spark_entry__ as entry


def test_no_column_is_rarely_missing(spark, tmp_path):
    """Events in one slot in two leave no column under the threshold: an empty answer, not an error."""
    start = datetime.datetime(2024, 1, 1)
    rows = [(start + datetime.timedelta(days=d, minutes=24 * (d % 53)), 1, float(d)) for d in range(20)]
    spark.createDataFrame(rows, "ts timestamp, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    found = entry.queries()["p9_low_null_columns"](spark, str(tmp_path))
    assert found.columns == ["side", "pos", "n", "total"] and found.collect() == []
