"""callweave: a PySpark-native engine for a continuously refreshed index of calls for papers."""

__version__ = "0.1.0"
