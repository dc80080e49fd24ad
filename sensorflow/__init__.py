"""Sensor-stream analytics on Spark DataFrames."""
