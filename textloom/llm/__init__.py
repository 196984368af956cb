"""Operators for building training data from web-scale text. Nothing else in the package imports this one."""
