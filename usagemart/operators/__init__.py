"""Operators: lazy DataFrame -> DataFrame functions without actions or Python UDFs."""
