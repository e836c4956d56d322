"""Small tables with the cases every operator must bear."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, length long, rank long, node string, root int, _key int, shard string, size string"


def edge_documents(spark):
    """Null ids, texts and sources, empty and very long texts, repeated rows."""
    texts = [None, "", "   \n\t ", "one", "one two", "One  TWO three\nfour", "x" * 5000, "ä ö ü " * 3000, "same text here", "same text here"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 2}", None) for i, t in enumerate(texts)]
    rows += [rows[3], rows[9], (None, "no id", None, None, 5), (None, "no id", "de", "s1", 5), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    """The documents with extra columns named like those that operators use inside."""
    return df.selectExpr("*", "1L AS length", "2L AS rank", "'n' AS node", "3 AS root", "4 AS _key", "'x' AS shard", "'y' AS size")
