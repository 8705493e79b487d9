"""Spark-native file intake, clean-up and reconciliation."""
