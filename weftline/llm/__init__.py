"""Operators for building language-model training data, and their registered queries.

Nothing outside this package imports it.  Each operator has a module of its own
with a general interface; ``queries`` holds one thin query per operator.
"""
