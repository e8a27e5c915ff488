"""Kerbline: road-safety analytics as Spark DataFrame operators."""
