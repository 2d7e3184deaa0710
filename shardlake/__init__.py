"""Log stores on Spark: sharded log groups as tables, decoded and encoded
with DataFrame expressions, with positions, progress and delivery checks."""
__version__ = "0.1.0"
