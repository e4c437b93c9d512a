"""A PySpark-native engine that turns nested paper-level documents into an object-level catalogue."""
