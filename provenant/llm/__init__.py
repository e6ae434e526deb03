"""Operators for large-scale training-data preparation.

Nothing outside this folder imports it (``__spark_entry__.py`` adds its queries when the import works).
"""
