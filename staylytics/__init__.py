"""PySpark-native hospitality analytics: cleaning, warehouse, marts, features, text, retrieval, insights, monitoring."""

__version__ = "0.1.0"
