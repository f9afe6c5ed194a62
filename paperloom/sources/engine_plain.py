"""Pages and words of a laid-out text file: form feeds end pages, a character's column and line are its place."""

from __future__ import annotations

import re

#: Points of a column and of a line.
WIDTH, HEIGHT = 8.0, 20.0


def _parts(body: bytes) -> list[str]:
    return body.decode().removesuffix("\f").split("\f")


def count(body: bytes) -> int:
    return len(_parts(body))


def cut(body: bytes, per: int):
    """Bodies of ``per`` pages each, the last one of what is left."""
    parts = _parts(body)
    for i in range(0, len(parts), per):
        yield "".join(p + "\f" for p in parts[i : i + per]).encode()


def pages(body: bytes, first: int = 1, last: int | None = None):
    yield from _parts(body)[first - 1 : last]


def words(body: bytes, first: int = 1, last: int | None = None):
    for n, page in enumerate(pages(body, first, last), first):
        for y, line in enumerate(page.split("\n")):
            for m in re.finditer(r"[^ ]+", line):
                yield n, m.start() * WIDTH, y * HEIGHT, m.end() * WIDTH, y * HEIGHT + HEIGHT / 2, m.group()
