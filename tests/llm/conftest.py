import random

import pytest

WORDS = "the valve pump gear oil seal shaft rotor gauge plate hose clamp under over before after check clean turn hold every each first last slow fast warm cold left right main spare bolt nut ring cover door panel light".split()


@pytest.fixture
def prose():
    def make(seed: int, n: int = 60) -> str:
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) for _ in range(n))

    return make
