"""Small documents with odd cases, and a check of column-clash safety."""

from __future__ import annotations

ODD_TEXTS = [
    (1, "Alpha beta gamma, delta! Épsilon 42 it's <|endoftext|> fine"),
    (2, None),
    (3, ""),
    (4, "Alpha beta gamma, delta! Épsilon 42 it's <|endoftext|> fine"),
    (5, "x" * 9000 + " tail"),
    (6, "Ligne ßtraße nöel  ΣΑΣ 日本語テキスト 🙂 İI \x1c a\x0bb"),
    (7, " \n\t "),
    (8, "word " * 9000),
    (8, "a second row of document 8"),
    (None, "no number"),
]


def documents(spark, rows=None, extra=True):
    """A documents table; with extra columns whose names operators use inside."""
    rows = ODD_TEXTS if rows is None else rows
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        for name in ("part", "rank", "length", "start", "component", "id", "key", "hash", "words"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(3)
