"""tollstream: variable-tolling stream analytics on Spark.

Operators are ``DataFrame -> DataFrame`` functions (``df.transform``-ready),
grouped as ``sources``, ``functions`` (column expressions), ``operators``,
``plans`` (end-to-end jobs) and ``streaming``.
"""

__version__ = "0.1.0"
