"""A PySpark-native analytics engine for keyed event streams and flight telemetry."""
