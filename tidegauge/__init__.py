"""Sensor-stream cleaning, windowed statistics and anomaly alerts on Spark DataFrames."""
