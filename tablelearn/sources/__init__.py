"""Readers and schema declaration."""

from .delimited import declare_schema, load_delimited

__all__ = ["declare_schema", "load_delimited"]
