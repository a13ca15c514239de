"""Lexweave: Spark jobs that turn legal and governance documents into a checked, searchable knowledge base."""

__version__ = "0.1.0"
