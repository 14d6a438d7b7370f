"""Documents with nulls, blanks, ties, repeats, long texts and a column with a clashing name."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, label string, size long"


def random_words(rng, n):
    return [rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa lamda mu".split())
            + str(rng.randrange(40)) for _ in range(n)]


def documents(seed=3):
    rng = random.Random(seed)
    shared = " ".join(random_words(rng, 60))
    base = random_words(rng, 150)
    rows = []
    for i in range(30):
        words = random_words(rng, rng.randrange(5, 200))
        text = " ".join(words)
        if i % 5 == 0:
            text = text + "\n" + shared + "\t" + " ".join(random_words(rng, 10))
        rows.append((i, text, "en" if i % 3 else "fr", f"src{i % 4}", "x", 1))
    for i in range(30, 42):  # near copies
        words = list(base)
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10_000))
        rows.append((i, " ".join(words), "en", "src0", None, None))
    rows += [
        (42, None, None, None, None, None),
        (43, "", "en", "src1", None, None),
        (44, " \t\n\x0b\f\r ", "en", None, None, None),
        (45, "one two", "en", "src1", None, None),
        (46, "Two Ñandú\u00a0x", None, "src2", None, None),
        (47, "42 % 17", "en", "src2", None, None),
        (None, rows[3][1], None, None, None, None),
        (None, "an id is missing here", "en", "src3", None, None),
        rows[2],
        rows[2],  # rows that are repeated whole
        (2, "another text with the id of a repeated row", "en", "src1", None, None),
        (48, rows[7][1], "en", "src2", None, None),
        (49, "no" * 60_000, "en", "src2", None, None),
        (50, " ".join(random_words(rng, 9_000)), "en", "src3", None, None),
        (51, "la la la " * 40, "fr", "src3", None, None),
    ]
    return rows


def table(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def sort_key(row):
    return tuple((v is None, str(v)) for v in row)
