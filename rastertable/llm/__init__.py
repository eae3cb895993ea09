"""Operators for building training corpora from text: one module each, all DataFrame in, DataFrame out.

Nothing outside this subpackage imports it. Every operator works on all rows and whole texts; null
texts count as empty.
"""
