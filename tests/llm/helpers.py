"""Small inputs with everything that operators must bear, and plain versions of what they compute."""

from __future__ import annotations

from collections import defaultdict

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns of the input whose names operators might use for their own.
CLASHES = ("bits", "hash", "size", "component", "copies", "place", "line", "label", "node", "target", "ids", "start")


def docs(spark, rows, clashes: bool = True):
    """``rows``: (doc_id, text) or the five columns of documents."""
    full = [(r + ("en", "src0", len(r[1]) if r[1] is not None else None)) if len(r) == 2 else r for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashes:
        df = df.selectExpr("*", *[f"'x' as {c}" for c in CLASHES])
    return df


def odd_rows() -> list[tuple]:
    """Null, empty, blank, very long, repeated and tied rows."""
    long = " ".join(f"word{i % 977} thing{i % 13}" for i in range(40_000))
    return [
        (1, "the same text of some length, told once more"), (2, "the same text of some length, told once more"),
        (2, "the same text of some length, told once more"), (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, long),
        (None, "a row without a number"), (None, None), (9, "a\n\nb\n\na"),
    ]


def groups_of(links: set[tuple], nodes) -> dict:
    """The smallest node that each reaches."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    label = {}
    for start in sorted(nodes):
        if start not in label:
            stack = [start]
            while stack:
                node = stack.pop()
                if node not in label:
                    label[node] = start
                    stack.extend(near[node])
    return label
