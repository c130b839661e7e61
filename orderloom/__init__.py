"""Retail order analytics as DataFrame-to-DataFrame functions on PySpark."""
