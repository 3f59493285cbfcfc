"""benthos: a PySpark-native analytics engine for footage reports."""
