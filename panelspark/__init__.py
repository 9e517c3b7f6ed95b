"""Spark-native analysis of wide intraday return panels."""
