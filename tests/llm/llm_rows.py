"""Rows that the tests of several operators share."""

#: Nulls, empty and blank texts, repeated rows, equal texts, odd characters, one long text.
ODD = [(None, "no id here, but words all the same for once"), (1, None), (2, ""), (3, " \n\t\n"),
       (4, "the quick brown fox jumps over the lazy dog near the old river bank today"),
       (4, "the quick brown fox jumps over the lazy dog near the old river bank today"),
       (5, "the quick brown fox jumps over the lazy dog near the old river bank today"),
       (6, "日本語 テキスト 🙂 naïve café\x00 \x85 end"), (7, "12345 --- !!!"),
       (8, " ".join(f"word{i * i % 9973}" for i in range(20_000)))]

SF_SMALL = "/root/testdata/sf0.001"


def docs_of(spark, pairs, lang="en"):
    """Documents from (doc_id, text) pairs, with columns that clash with
    names the operators use inside."""
    rows = [(i, t, lang, "s", None if t is None else len(t), "x", 1, "y") for i, t in pairs]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "line string, node long, key string")
