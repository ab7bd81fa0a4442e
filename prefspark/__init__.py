"""Preference-alignment data work as Spark DataFrame operators."""
