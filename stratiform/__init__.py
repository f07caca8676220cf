"""Layered (bronze, silver, gold) analytics as composable Spark DataFrame operators.

Operators are plain functions from DataFrame to DataFrame, meant for
``df.transform``.  Only ``sinks``, ``streaming`` and the two rewriting helpers
of ``operators.layout`` run jobs that write data.
"""

__version__ = "0.1.0"
