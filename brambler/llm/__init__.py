"""Operators for building training corpora at scale. Nothing else in the package imports this subpackage."""
