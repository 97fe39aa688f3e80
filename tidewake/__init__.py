"""Vessel-tracking and emissions analytics as Spark DataFrame operators."""
