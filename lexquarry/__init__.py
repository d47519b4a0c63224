"""lexquarry: a Spark-native engine for structuring collections of legal documents."""

VERSION = __version__ = "0.2.0"
