"""feescope: transaction load and fee analytics as Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built on
``pyspark.sql.functions``; domain constants live in :mod:`feescope.config`.
"""

from feescope.config import ChainSpec, DEFAULT_SPEC

__all__ = ["ChainSpec", "DEFAULT_SPEC"]
