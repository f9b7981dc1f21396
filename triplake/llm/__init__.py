"""Operators for building training corpora; nothing else in the library imports this package.

One module per operator (``cap_dedupe`` ... ``shingle_join``), each with a
general interface and one registered query; ``catalog`` collects the
queries and their SQL.
"""
