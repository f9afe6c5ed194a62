"""All registered queries of the document operators."""

from __future__ import annotations

from . import composed, documents, pipelines, relations, scalars  # noqa: F401  register
from .registry import QUERIES, Query


def queries() -> dict[str, Query]:
    return QUERIES
