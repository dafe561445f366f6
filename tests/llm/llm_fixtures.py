"""Fixtures that tests of this folder import by name."""

import pytest

#: Columns whose names operators use themselves, beside those of the documents table.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans int, hits string, size double, t int"


def row(number, text):
    return (number, text, "en", "src0", len(text) if text is not None else None, "x", 3, "y", 1.5, 9)


PROSE = " ".join(f"word{n} goes with plain text" for n in range(40))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, odd characters."""
    long = " ".join(f"w{n % 977} and{n}" for n in range(30_000))
    rows = [row(1, PROSE), row(1, PROSE), row(2, None), row(3, ""), row(4, " \t\n"), row(None, PROSE), row(None, "lone text " * 3),
            (None,) * 10, row(5, long), row(6, "café \U0001F600 naïve <|endoftext|>   x\x1c\x00y"), row(7, "a" * 5000),
            row(8, PROSE + " tail"), row(9, "one"), row(9, "two")]
    return spark.createDataFrame(rows, CLASHING)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], CLASHING)
