import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions.text import WHITE_SPACE, cut_bytes, with_bounded_text

CHARACTERS = ["a", " ", "é", "…", "𝄞", "　"]


def expected_cut(text: str, limit: int) -> str:
    return text.encode()[:limit].decode(errors="ignore")


def expected_bounded(text: str, limit: int) -> str:
    text = text.strip(WHITE_SPACE)
    return text if len(text.encode()) <= limit else expected_cut(text, limit - 3) + "…"


def texts(limit: int) -> list[str]:
    rng = random.Random(7)
    cases = ["", "   ", "x" * (limit - 1), "x" * limit, "x" * (limit + 1), "x" * limit + "  "]
    for wide in ("é", "…", "𝄞"):
        for lead in range(limit - 5, limit + 3):
            cases += ["x" * lead + wide, "x" * lead + wide * 3, "\t " + "x" * lead + wide]
    for _ in range(200):
        cases.append("".join(rng.choices(CHARACTERS, k=rng.randint(0, limit))))
    return cases


@pytest.mark.parametrize("limit", [10, 64, 512])
def test_bytes_are_bounded_on_character_boundaries(spark, limit):
    cases = texts(limit)
    df = spark.createDataFrame(list(enumerate(cases)), "i INT, text STRING")
    df = with_bounded_text(df, "bounded", F.col("text"), limit)
    rows = df.select("text", "bounded", cut_bytes(F.col("text"), limit).alias("cut")).collect()
    assert len(rows) == len(cases)
    for row in rows:
        assert row.bounded == expected_bounded(row.text, limit)
        assert row.cut == expected_cut(row.text, limit)


def test_white_space_set_is_the_unicode_property():
    assert len(WHITE_SPACE) == 25
    # str.isspace knows four separators more than the property.
    others = {c for c in map(chr, range(0x110000)) if c.isspace()} - set(WHITE_SPACE)
    assert others == set("\x1c\x1d\x1e\x1f")
