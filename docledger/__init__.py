"""Spark-native toolkit for document registers: load, derive, reconcile, explain, trace."""
