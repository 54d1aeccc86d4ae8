"""A PySpark-native engine for entity resolution and corpus preparation."""
