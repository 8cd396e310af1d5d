"""Small document tables with the awkward cases, and brute-force helpers."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "ou", "an", "er", "ist", "ung")]


def lower(text: str) -> str:
    """A-Z only."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(n))


def edited(rng: random.Random, text: str, changes: int) -> str:
    parts = text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = prose(rng, 1)
    return " ".join(parts)


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, seed: int = 1):
    """Copies, near copies, repeats, nulls in every column, empty, blank and very long texts, repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 4, 5, 6, 40, 120, 200])) for _ in range(40)]
    hub = prose(rng, 100)
    passage = prose(rng, 50)
    texts = [
        *base,
        *base[:6],
        *(edited(rng, t, 1) for t in base[6:20]),
        *(edited(rng, hub, rng.randrange(1, 4)) for _ in range(40)),
        hub,
        base[20].upper().replace(" ", "\t\n"),
        *(f"{prose(rng, 30)} {passage} {prose(rng, rng.randrange(20))}" for _ in range(10)),
        prose(rng, 20_000),
        " ".join([prose(rng, 40)] * 3),
        "x" * 100_000,
        "é😀 ñandú    Straße " * 30,
        "", "   \t", None, "a", "A", "a b c d e",
    ]
    rows = [(i * 3, t, rng.choice(["en", "de", None]), f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows[4] = (*rows[4][:3], None, None)
    rows += [rows[0], rows[45], rows[-1]]
    rows += [(None, base[3], None, None, None), (None, None, None, None, None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCUMENT).repartition(3)


CLASHING = (
    "n block token node tokens h1 h2 class keys totals component held_out score spans _spans copy shuffle_key _row _known "
    "_text _u _source _leaks kept rank lang_pred _assign"
).split()


def with_clashes(df):
    """The same rows with extra columns that are named like the operators' own."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(-7) for c in CLASHING})
