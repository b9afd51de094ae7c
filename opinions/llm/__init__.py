"""Operators for preparing training data; nothing else in the package imports this subpackage."""
