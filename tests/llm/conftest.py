import random

import pytest

WORDS = ("river stone garden winter letter market bridge window teacher harbour village engine summer paper doctor "
         "forest island carpet mirror candle travel market silver kitchen orange planet button castle dinner shadow").split()


@pytest.fixture
def prose():
    """prose(n, seed): n words of plain sentences."""

    def make(n: int, seed: int) -> str:
        rng = random.Random(seed)
        out, left = [], n
        while left > 0:
            k = min(left, rng.randint(5, 11))
            out.append(" ".join(rng.choice(WORDS) + str(rng.choice("abcdefghij")) for _ in range(k)).capitalize() + ".")
            left -= k
        return " ".join(out)

    return make


@pytest.fixture
def frame(spark):
    """frame(rows, schema): a DataFrame dealt over several partitions."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)

    return make
