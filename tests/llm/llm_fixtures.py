"""Invented prose for the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone garden window morning letter market winter silver bridge candle forest engine paper shadow".split()


def prose(seed: int, n: int) -> str:
    """Plain sentences of invented words, repeatable."""
    rng, out = random.Random(seed), []
    while n > 0:
        size = min(n, rng.randint(6, 12))
        words = [rng.choice(WORDS) + rng.choice(["", "s", "ly", "er"]) + rng.choice(["", "ton", "mar", "wick"]) for _ in range(size)]
        out.append(" ".join(words).capitalize() + ".")
        n -= size
    return " ".join(out)
