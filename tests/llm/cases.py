"""Small tables with the rows that operators must not stumble over, and plain-Python counterparts."""

import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Every column null, clashing names, repeated rows.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, n_hit long, spans string, items string, "
          "label string, key long, bucket long, a long, b long, size long, hash long, copies long, kept string, score string, digest string")


def words(text, rule=ALNUM):
    return rule.findall((text or "").translate(_LOW))


def prose(seed, n, vocabulary=400):
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def table(spark, rows):
    """Rows of (doc_id, text, lang, source), with clashing extra columns."""
    full = [(i, t, lang, s, len(t or ""), 7, 8, "x", "y", "z", 1, 2, 3, 4, 5, 6, 9, "k", "s", "d") for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    return [(None, "some text", "en", "a"), (900, None, None, None), (901, "", "en", ""), (902, " \t\n ", None, "a"), (903, "!!! ...", "en", None),
            (904, "one", "en", "a"), (905, "Ünï çødé é中文 \u0000 x", "de", "b")]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
