"""Operators of a training-data pipeline over a table of documents.

Every module holds one operator with its own general interface; ``queries`` holds the thin
``opN_*`` queries over the standard tables. Nothing outside this folder imports it.
"""
