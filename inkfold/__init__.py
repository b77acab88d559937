"""inkfold: a PySpark-native engine for collections of authored text."""

__version__ = "0.1.0"
