"""tickmill: a PySpark-native analytics engine for timed decision data."""
