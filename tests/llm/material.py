"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random
import re

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
DOCUMENTS = "doc_id long, text string, lang string, source string, size string, node string, `key` string, n string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", str(rng.randint(0, 99))]) for _ in range(n))


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents(spark, texts: list[tuple[int | None, str | None]], partitions: int = 3):
    """Rows with further columns whose names the operators use themselves."""
    rows = [(i, t, "en" if k % 2 else None, ["b", "a", None][k % 3], "x", "y", "z", "w") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(partitions)


def awkward() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows, a null id, near copies and a long text."""
    base = prose(1, 120)
    changed = base.split(" ")
    changed[60] = "changed"
    passage = prose(99, 50)
    return [
        (1, base), (2, base), (2, base), (3, " ".join(changed)), (4, None), (5, ""), (6, " \n\t "), (7, "one two"),
        (8, "One  two"), (9, prose(2, 30) + "\n" + passage + " " + prose(3, 40)), (10, passage + "\t" + prose(4, 10)),
        (None, prose(5, 80)), (None, None), (11, "a b c d e f g " * 300), (12, prose(6, 20_000)), (13, "é ß 😀 𝔘 \\ < [ 漢字"),
    ]
