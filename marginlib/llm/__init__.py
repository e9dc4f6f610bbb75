"""Operators for training-data pipelines over documents, pages and conversations.

Nothing outside this subpackage imports it; `__spark_entry__.py` adds its
queries when the subpackage is present.
"""
