"""Spark batch analytics for municipal parking spots and their reservations.

Everything is a function from DataFrames to a DataFrame: lazy, free of session state, and
built on Spark SQL expressions. ``functions`` holds column expressions, ``operators`` the
single steps, ``plans`` the composed layers, ``sources`` readers and writers.
"""
