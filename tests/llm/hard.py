"""Small tables with everything that is awkward in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, vocabulary=400):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def hard_rows():
    base = words(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = words(2, 40)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, " ".join(near), "en", "b", 1),
        (4, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, " \n\t ", "en", None, 4),
        (7, "one two", None, "a", 7),
        (8, "ONE two", "fr", "a", 7),
        (9, "12345 !!! ###", "en", "b", 13),
        (10, words(3, 60) + " " + passage, "de", "b", 1),
        (11, passage + "\n" + words(4, 60), "de", "b", 1),
        (12, words(5, 6000, 3000), "en", "c", 1),
        (13, "same line\nsame line\n\nsame line", "en", "c", 1),
        (14, "é" * 500 + " x " + "ü ß", "de", "c", 1),
        (-7, words(6, 90), "es", "c", 1),
        (15, words(7, 2048), "es", "c", 1),
        (None, words(8, 80), "en", "d", 1),
        (None, base, "en", "d", 1),
    ]
    rows += [(100 + i, words(9, 50), "en", "a", 1) for i in range(30)]
    return rows + [rows[0]]  # a repeated row


def hard_documents(spark, extra=False):
    df = spark.createDataFrame(hard_rows(), SCHEMA)
    if extra:
        for name in ("score", "kept", "n_words", "labels", "rule", "topic", "probability", "hash", "copy", "size", "bin", "length", "cluster"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
