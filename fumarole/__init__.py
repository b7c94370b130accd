"""Sensor-telemetry analytics on Spark DataFrames."""
