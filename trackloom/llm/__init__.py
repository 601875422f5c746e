"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

``queries()`` and ``oracle_sql()`` list the registered queries; each one is a thin function over an
operator of this folder, which keeps its own general interface.
"""
