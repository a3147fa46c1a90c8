"""Texts for the tests."""

import random


def prose(seed, n_words=60):
    draw = random.Random(seed)
    parts = "the of re tion ing an ver ka lo mi su te na ro di".split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n_words))
