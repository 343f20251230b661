"""Fixtures of the corpus tests, imported by name: a second conftest would hide the first."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quadrille.llm.common import prepare  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


@pytest.fixture
def made(spark):
    """Documents from pairs of id and text, with extra columns whose names operators use inside."""

    def make(pairs, lang=None):
        rows = [(i, t, lang, f"s{k % 3}" if k % 4 else None, k, "x", k % 2) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id int, name string, row int")

    return make


@pytest.fixture
def prose():
    """Sentences of invented words, the same for each seed."""

    def write(words, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["the", "an", "ion", "er", "st", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(words))

    return write
