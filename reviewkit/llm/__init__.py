"""Operators for preparing training data at corpus scale.

One module per operator; :mod:`reviewkit.llm.queries` registers the queries.
Nothing outside this package imports it.
"""
