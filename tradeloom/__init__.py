"""Retail warehouse and analytics jobs written as PySpark DataFrame programs."""
