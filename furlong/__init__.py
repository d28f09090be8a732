"""furlong: a PySpark-native engine for sports-results fact data."""
