"""Tables with the awkward rows that every operator must take."""

DOC_SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "row string, score double, key string, start int, shard int, n int, part string, token string, block int")
EXTRA = ("r", 0.5, "k", 1, 2, 3, "p", "t", 4)


def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, equal texts, clashing columns."""
    words = " ".join(f"wort{i % 977} été{i % 31}" for i in range(20_000))
    rows = [
        (1, "one two three four five six seven", "en", "s1"),
        (1, "one two three four five six seven", "en", "s1"),
        (2, None, None, None),
        (3, "", "en", "s1"),
        (4, words, "fr", "s2"),
        (5, words, "fr", None),
        (None, "no id at all but words", "en", "s2"),
        (6, "a b", "de", "s1"),
        (7, " \n\t ", "de", "s2"),
        (8, "12 34 !!", "de", "s2"),
        (9, "x" * 70_000, "de", "s2"),
        (None, None, None, None),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in rows], DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
