"""Small documents with nulls, empty and long texts, ties, copies, and columns whose names clash with the operators' own."""

import random

WORDS = "the of and harbour lantern window garden silver copper meadow river stone winter summer paper letter bridge castle candle forest mirror".split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, word string, block long"


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + (str(r.randrange(999)) if r.random() < 0.5 else "") for _ in range(n))


def rows():
    base, passage = prose(120, 1), prose(70, 2)
    near = base.split()
    near[5] = "changed"
    texts = {
        1: base, 2: base, 3: " ".join(near), 4: prose(90, 3) + "\n" + passage, 5: prose(40, 4) + " " + passage + "\n" + prose(30, 5), 6: None, 7: "", 8: " \n\t ", 9: "One two", 10: "one  TWO",
        11: prose(4000, 6), 12: "x " * 300, 13: "ÀÉ ﷽ 日本語 naïve\r\n\x00 end", 14: passage, 15: prose(60, 7), 16: "a" * 3000, 17: "same line here\nsame line here\n\nother #tag",
    }
    return [(i, t, "en" if i % 2 else None, "src" if i % 3 else None, len(t) if t else None, 0.5, "w", 3) for i, t in texts.items()]


def frame(spark, more=()):
    return spark.createDataFrame([*rows(), *more], COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
