"""Interval-meter load analytics as Spark DataFrame operators."""
