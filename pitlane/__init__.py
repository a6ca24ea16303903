"""Lap and telemetry analytics as PySpark DataFrame operators."""
