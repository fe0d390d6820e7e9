"""Flat business extracts from a hub / link / satellite warehouse, on Spark."""
