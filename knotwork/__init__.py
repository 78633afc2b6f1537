"""Concept-graph analytics on PySpark: link graphs, concept documents, path queries and data checks."""
