"""Small tables with awkward rows, shared by the tests of this package."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, rows, schema=DOCS):
    """Documents from (doc_id, text) or longer rows."""
    full = [(*row, *("en", "s")[len(row) - 2:], len(row[1]) if row[1] is not None else None) if len(row) < 5 else row
            for row in rows]
    return spark.createDataFrame(full, schema)


def prose(seed, words, vocabulary=4000):
    """Invented words in a fixed order for the seed."""
    import random

    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))
