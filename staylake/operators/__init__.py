"""DataFrame operators: quality rules, metrics, extraction, reviews, keys, merges."""

from . import extract, keys, merge, metrics, quality, reviews  # noqa: F401
