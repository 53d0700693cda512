"""Made-up prose that is the same on every run."""

import random

WORDS = [a + b + c for a in ("th", "on", "re", "ing") for b in ("a", "er", "ou") for c in ("n", "st", "le", "")]


def prose(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ",", "."]) for _ in range(count))
