"""Brindle: everyday data-engineering work as PySpark DataFrame and stream functions."""
