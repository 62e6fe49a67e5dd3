import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def words():
    """Seeded prose from a small vocabulary."""
    def make(n, seed):
        r = random.Random(seed)
        vocab = ["".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randint(2, 7))) for _ in range(400)]
        r = random.Random(seed * 7 + 1)
        return [r.choice(vocab) for _ in range(n)]
    return make
