from __future__ import annotations

import random
from pathlib import Path

import pytest

SMALL = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that the operators use inside
CLASHES = "row string, id string, size string, recipe string, keep_id string, stamp string, score string, spans string, mix_taken string, node string, weight string, lang_pred string, component_id string"


def prose(words: int, seed: int) -> str:
    draw = random.Random(seed)
    stock = [f"{a}{b}" for a in ("ba", "ko", "ti", "mu", "re", "sal") for b in ("n", "rt", "lo", "x", "pe", "dun", "via")]
    return " ".join(draw.choice(stock) for _ in range(words))


@pytest.fixture(scope="session")
def small():
    if not SMALL.exists():
        pytest.skip("no test tables")
    return str(SMALL)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (doc_id, text[, source]) tuples."""

    def make(rows):
        full = []
        for k, r in enumerate(rows):
            r = (k, r) if r is None or isinstance(r, str) else r
            full.append((r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, repeated rows and names that clash with the operators' own."""
    long_text = prose(60_000, 1)
    body = prose(40, 2)
    rows = [
        (1, body, "en", "a", 1),
        (1, body, "en", "a", 1),
        (2, body.upper(), None, None, None),
        (None, body, "en", "a", 1),
        (None, "only here " + prose(30, 3), None, "b", None),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "fr", "b", 4),
        (6, long_text, "de", "c", 1),
        (7, "x" * 200_000, "de", None, 1),
        (8, "1" * 50_000 + " " + "1 " * 20_000 + "a@b" + ".c" * 20_000, "es", "c", 1),
        (9, "é" * 30 + " 日本 " + "😀" * 20, "zz", "c", 1),
        (None, None, None, None, None),
    ]
    names = [c.split()[0] for c in CLASHES.split(", ")]
    return spark.createDataFrame([(*r, *["kept"] * len(names)) for r in rows], f"{SCHEMA}, {CLASHES}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
