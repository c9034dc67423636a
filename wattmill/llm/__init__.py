"""Operators for training-data pipelines over the ``documents`` tables. Nothing else in the package imports them."""
