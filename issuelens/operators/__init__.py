"""Operators: DataFrame -> DataFrame building blocks of the reports."""
