"""Batch card-payment risk analytics as Spark DataFrame jobs."""
