"""Small tables with every kind of odd row."""

ODD_TEXTS = [None, "", " ", "one", "one two three four five six seven.", "x" * 5000, "é 😀 \t\n a", "a b " * 2000]
#: Columns that operators use inside, to clash with theirs.
CLASHING = ("row", "fp", "root", "u", "v", "cell", "base", "terms", "score", "text_hash", "_id", "_row", "_hash", "hash", "tox", "piece")


def odd_docs(spark):
    """Nulls everywhere, empty and long texts, a repeated row, a repeated id, clashing columns."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "one two three four five six seven."), (3, "one"), (3, "else"), (None, None)]
    names = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *("z" if n % 2 else None for n in range(len(CLASHING)))) for i, t in rows], f"doc_id long, text string, {names}")


def texts(spark, values, first=0):
    return spark.createDataFrame(list(enumerate(values, first)), "doc_id long, text string")
