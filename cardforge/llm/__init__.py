"""Operators of a training-data pipeline (documents, pages, embeddings).

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and their SQL; the operators are one module each.
"""
