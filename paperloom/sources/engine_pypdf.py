"""Pages of a PDF by pypdf, where it is installed."""

from __future__ import annotations

import io

import pypdf


def count(body: bytes) -> int:
    return len(pypdf.PdfReader(io.BytesIO(body)).pages)


def pages(body: bytes, first: int = 1, last: int | None = None):
    yield from (page.extract_text() or "" for page in pypdf.PdfReader(io.BytesIO(body)).pages[first - 1 : last])


def words(body: bytes, first: int = 1, last: int | None = None):
    raise NotImplementedError("this engine gives no boxes")
