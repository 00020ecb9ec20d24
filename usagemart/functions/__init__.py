"""SQL fragments shared by the operators: each takes and returns expression text.

All are built-in Spark expressions, so whatever uses them stays inside generated code.
"""
