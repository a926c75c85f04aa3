"""Operators for building training corpora: token counts, de-duplication, archives, quality and packing.

Nothing else in the library imports this subpackage.
"""
