"""Operators over long tables: ``f(df, *, key, time, value, ...) -> DataFrame``."""
