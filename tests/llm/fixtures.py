"""Small tables with every case that operators have to bear."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("_key", T.StringType()), T.StructField("node", T.StringType()), T.StructField("row", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("_text", T.StringType()), T.StructField("n_words", T.StringType())])


def words(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


_rng = random.Random(7)
VOCABULARY = ["".join(_rng.choice("abcdefghijklmnoprstuväéß") for _ in range(_rng.randint(2, 9))) for _ in range(900)]


def texts(seed=1):
    """Texts with near and exact copies, shared lines, repeats within, edges of word counts, and a very long one."""
    rng = random.Random(seed)
    base = words(rng, 120)
    out = [" ".join(words(rng, rng.randint(1, 160))) for _ in range(25)]
    for k in (0, 1, 2, 5, 9, 14, 20, 30):  # copies with more and more changes
        copy = list(base)
        for _ in range(k):
            copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
        out.append(" ".join(copy))
    line = " ".join(words(rng, 60))
    for k in range(6):
        out.append("\n".join([" ".join(words(rng, 15)), line if k % 2 else line.upper(), " ".join(words(rng, 12))]))
    phrase = " ".join(words(rng, 9))
    out.append(" ".join([phrase] * 6 + words(rng, 10)))
    out.append("\n".join([phrase, "", phrase, " \t ", "é ###$ <b>|%", phrase]))
    out += ["", " \n\t ", "one", "a b c d", "a b c d", "a b c d e", "A b C d e", "x" * 49, "x" * 50, "x" * 51, "\n".join(["y" * 60] * 3),
            "日本 語 テキスト " * 12, "▁ mark", "tab\tand\x0bfeed"]
    long = words(rng, 60_000)
    out += [" ".join(long), " ".join(long[:-3])]
    return out


def messy_rows(seed=1):
    """Rows for ``DOCS``: nulls in every column, rows that repeat, one id with two texts."""
    rng = random.Random(seed)
    rows = []
    for i, text in enumerate(texts(seed)):
        lang = None if i % 11 == 3 else rng.choice(["en", "de"])
        source = None if i % 7 == 2 else rng.choice(["s1", "s2"])
        rows.append((100 + i, text, lang, source, len(text), "k", None, "r", "q", None, "w"))
    rows.append((5, None, "en", "s1", None, None, None, None, None, None, None))
    rows.append(rows[3])
    rows.append(rows[3])
    rows.append((rows[4][0], rows[26][1], *rows[4][2:]))
    rows.append((None, rows[27][1], None, None, 3, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None, None))
    rng.shuffle(rows)
    return rows
