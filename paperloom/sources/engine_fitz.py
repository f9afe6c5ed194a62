"""Pages and words of a PDF by fitz, where it is installed."""

from __future__ import annotations

import fitz


def count(body: bytes) -> int:
    with fitz.open(stream=body, filetype="pdf") as doc:
        return doc.page_count


def pages(body: bytes, first: int = 1, last: int | None = None):
    with fitz.open(stream=body, filetype="pdf") as doc:
        yield from (doc[i].get_text() for i in range(first - 1, last or doc.page_count))


def words(body: bytes, first: int = 1, last: int | None = None):
    with fitz.open(stream=body, filetype="pdf") as doc:
        for i in range(first - 1, last or doc.page_count):
            for x0, y0, x1, y1, text, *_ in doc[i].get_text("words"):
                yield i + 1, x0, y0, x1, y1, text
