"""Operators of a training-data pipeline: ten corpus operators and their queries.

Nothing else in the package imports this subpackage.  Each operator module has
a general interface over DataFrames; :mod:`feescope.llm.registry` binds them to
the given tables as queries ``opN_<name>``.
"""
