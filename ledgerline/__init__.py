"""Batch analytics for ordered event logs, expressed as Spark DataFrame plans."""
