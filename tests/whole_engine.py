"""The plain engine for tests, without a way to cut a body."""

from paperloom.sources.engine_plain import count, pages, words  # noqa: F401
