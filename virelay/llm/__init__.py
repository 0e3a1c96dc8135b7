"""Training-data operators: deduplication, extraction, search, tokenisation.

Nothing else in the library imports this subpackage.  ``queries`` holds the
``opN_<name>`` callables and their SQL.
"""
