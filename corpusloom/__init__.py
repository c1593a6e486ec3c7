"""corpusloom: a PySpark engine for document-corpus analytics."""

__version__ = "0.1.0"
