"""Column-level functions: text, dates and JSON field access."""

from . import dates, text  # noqa: F401
