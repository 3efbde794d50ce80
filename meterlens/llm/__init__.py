"""Operators of a training-data pipeline over document, page, vector and
conversation tables.  Nothing else in the package imports this subpackage."""
