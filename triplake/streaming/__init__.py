"""Streaming forms of the two stateful operators (dedupe, outcome join).

The stateless operators (rules, routing, projections, features) are plain
Columns and apply to streaming DataFrames unchanged.
"""
