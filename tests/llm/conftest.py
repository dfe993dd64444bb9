from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size string, row struct<a:int>, hash long"


def messy_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows; columns with clashing names."""
    long = " ".join(f"word{i % 977} and." for i in range(60_000))
    base = [
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", "en", "s1"),
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", "en", "s1"),
        (2, "", "en", "s1"),
        (3, None, "en", None),
        (None, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu.", None, "s1"),
        (None, None, None, None),
        (4, " \n\t ", "fr", "s2"),
        (5, long, "en", "s2"),
        (6, "1234 5678 !!! ???", "xx", "s3"),
        (7, "Der die das und nicht mit einem Satz über Öl und Größe", "de", "s3"),
        (8, "Licensed under the Apache License, Version 2.0.\nSome other words here.", "en", "s3"),
        (9, "Some line that many share\n" * 4 + "own words here", "en", "s3"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), "x", None, 5) for r in base]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), COLUMNS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
