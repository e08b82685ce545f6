"""Spark-native privacy and data-quality engine for order, open-order and inventory extracts."""
