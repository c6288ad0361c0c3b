"""Invented prose for the corpus tests."""

import random

SYLLABLES = "an re mo li ta ve sho kin der pa lo nu".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    text = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("\n" if rng.random() < 0.08 else "") for w in text).replace("\n ", "\n")


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join("changed" + str(rng.random()) if rng.random() < share else w for w in text.split(" "))
