"""An engine for tests: pages are parted by form feeds, words stand one after the other; a text that begins with ! is broken."""


def pages(body):
    text = body.decode()
    if text.startswith("!"):
        raise ValueError("broken")
    return text.split("\f")


def words(body):
    for n, page in enumerate(pages(body), 1):
        for i, w in enumerate(page.split()):
            yield n, 10.0 * i, 5.0, 10.0 * i + 8, 15.0, w
