"""Operators for preparing language-model training text.

Nothing else in the library imports this package; ``__spark_entry__`` adds its queries when it is present.
"""
