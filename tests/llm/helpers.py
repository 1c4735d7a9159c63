"""Small documents with every odd case, and plain versions of what the operators do."""

import random

from stockflow.llm.common import WORD

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents(seed: int = 1) -> list[tuple]:
    """NULLs in every column, empty and long texts, exact and near copies, repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def text(n: int) -> str:
        return " ".join(rng.choice(words) for _ in range(n))

    base, passage, long = text(90), text(25), text(4000)
    texts = [None, "", " \n ", "one", "one two three", "one", base, base, long, long + " end", text(60), "x" * 5000]
    for _ in range(12):
        near = base.split(" ")
        near[rng.randrange(len(near))] = "changed"
        texts.append(" ".join(near))
    texts += [f"{text(30)} {passage} {text(30)}" for _ in range(6)] + [passage, passage + "\n" + passage]
    rows = [
        (i * 3 % 101, t, rng.choice(["en", None]), rng.choice(["a", "b", None]), None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    rows += [(None, base, "en", "a", 1), (None, None, None, None, None), rows[6], rows[6], (rows[9][0], text(40), "fr", "b", 7)]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_documents() if rows is None else rows, COLUMNS)


def grams(text: str | None) -> frozenset:
    words = WORD.findall(text or "")
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def groups(n: int, links: list[tuple[int, int]]) -> list[int]:
    """The smallest index reachable from each index."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return [root(i) for i in range(n)]
