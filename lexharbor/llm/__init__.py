"""Operators for text and vectors of training data. Nothing else in the library imports this subpackage."""
