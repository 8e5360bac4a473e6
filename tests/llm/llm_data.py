"""Rows that the tests of this folder share."""

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


#: Nulls, empty and blank texts, ties, repeated rows, odd characters, a text without white space, a long text.
ODD = [
    (1, None),
    (2, ""),
    (3, "  \n"),
    (4, "one"),
    (4, "one"),
    (5, "one two"),
    (None, "a row without a key but with words"),
    (6, "Ärger über ñandú — ﬁn “x” ß ẞ İ Σ 日本語   é <|endoftext|> \x1c \x85 don't WE'LL 12³"),
    (7, "x" * 70_000),
    (8, "the long road " * 9_000),
    (9, "a row without a key but with words"),
]
