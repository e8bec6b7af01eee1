"""Intermediate tables of the training-data operators."""

from ..work import Work, delete, shared_dir  # noqa: F401
