"""Awkward documents: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, source string, key string, raw string, size string, label int, token string, class string, component_id string, kept string, n_words string"


def words(n: int, seed: int, vocabulary: int = 5000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents() -> list[tuple[int | None, str | None]]:
    base, passage = words(80, 1), words(90, 2)
    near = base.split()
    near[40] = "changed"
    texts = [
        None, "", " \t\n ", "one", "one two three four", base, base, " ".join(near), base.upper(), words(60, 3) + "\n" + passage + "\n" + words(70, 4), passage + " " + words(50, 5), "x" * 1500,
        "äöü ß ﬁ " * 90, "日本語 テキスト " * 80, words(3000, 6), "a b c d e " * 60, "<|endoftext|> </s> [INST]", "same line here\n" * 30, "e\u0301t\u00e9 \U0001f600 " * 5,
    ]
    rows = list(enumerate(texts))
    return [*rows, (5, base), (12, "another text with the id of the umlauts"), (None, "no id at all but words enough to be a text of ten words"), (None, None)]
