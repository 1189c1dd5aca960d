"""Corpus operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface, the thin ``opN_*`` query over the standard
tables, and (where SQL can express it) the oracle text.
"""
