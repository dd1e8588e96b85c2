"""A small table of documents with every awkward case, and its variants."""

from __future__ import annotations

WORDS = [f"{a}{b}" for a in ("mor", "tal", "vin", "sek", "dop", "lur", "gan", "pim") for b in ("en", "is", "ota", "ul", "ax", "emi")]


def prose(seed: int, n: int) -> str:
    out, state = [], seed * 7919 + 13
    for i in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)] + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def edited(text: str, places: list[int]) -> str:
    parts = text.split(" ")
    for p in places:
        parts[p] = "changed" + str(p)
    return " ".join(parts)


BASE = prose(1, 200)
LONG = prose(99, 30_000)
DOCS = [
    (1, BASE),
    (2, BASE),
    (3, edited(BASE, [50])),
    (4, edited(BASE, [20, 60, 100, 140, 180])),
    (5, prose(2, 150)),
    (6, None),
    (7, ""),
    (8, " \n\t "),
    (9, "one two"),
    (10, "one two"),
    (11, LONG),
    (12, LONG + " end"),
    (13, "éèß 中文 🙂 Ünïcode ſtraße"),
    (14, prose(3, 120)),
    (14, prose(3, 120)),
    (None, prose(4, 60)),
    (None, None),
    (-5, prose(5, 80)),
]


def documents(spark, rows=DOCS):
    """With extra columns whose names the operators also use."""
    schema = "doc_id long, text string, kept boolean, n long, component long"
    return spark.createDataFrame([(i, t, None, 7, 7) for i, t in rows], schema).repartition(3)


def empty(spark):
    return documents(spark, [])
