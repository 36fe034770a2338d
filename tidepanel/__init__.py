"""tidepanel: a Spark-first analytics library for entity x date panels."""

__version__ = "0.1.0"
