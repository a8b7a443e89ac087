"""Fixtures shared by the operator tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int, parts: str = "the an er in on tion re at en or es ed") -> str:
    words = ["".join(rng.choice(parts.split()) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def odd_texts() -> list[str | None]:
    return [None, "", " ", "\n", "a", "é", "12 34", "x" * 3000, "word " * 5000, "Straße İstanbul ΑΣ 日本 😀", "a<|endoftext|> b",
            "tab\tand\x1cseparators\r\nend ", "\n\n\n"]


def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(odd_texts())]
    rows += [(3, "repeated row", "en", "s", 1)] * 2 + [(None, "no id", "en", "s", 1), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("th", "h", "fp", "key", "lines", "gone", "chunk", "start", "root", "id", "at"):
        frame = frame.selectExpr("*", f"'clash' AS `{name}`")
    return frame


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def as_set(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
