"""Pages and words of a PDF by pdfplumber, where it is installed."""

from __future__ import annotations

import io

import pdfplumber


def count(body: bytes) -> int:
    with pdfplumber.open(io.BytesIO(body)) as doc:
        return len(doc.pages)


def pages(body: bytes, first: int = 1, last: int | None = None):
    with pdfplumber.open(io.BytesIO(body)) as doc:
        yield from (page.extract_text() or "" for page in doc.pages[first - 1 : last])


def words(body: bytes, first: int = 1, last: int | None = None):
    with pdfplumber.open(io.BytesIO(body)) as doc:
        for n, page in enumerate(doc.pages[first - 1 : last], first):
            for w in page.extract_words():
                yield n, w["x0"], w["top"], w["x1"], w["bottom"], w["text"]
