"""Training-data operators over a ``documents`` table (doc_id, text, ...).

Nothing else in the library imports this subpackage.  ``queries.py`` holds the
thin contract queries, the other modules hold one operator each.
"""
