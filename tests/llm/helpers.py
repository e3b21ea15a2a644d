"""Small awkward inputs that the operator tests share."""

import os

SF = "/root/testdata/sf0.001"
HAVE_TABLES = os.path.isdir(SF)

LONG = " ".join(f"word{n}" for n in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog.\nA second line of text.\nshort"),
    (2, "the quick brown fox jumps over the lazy DOG.  \nAnother line, only here.\nshort"),
    (2, "the quick brown fox jumps over the lazy DOG.  \nAnother line, only here.\nshort"),
    (3, ""), (4, None), (5, "   \t \n "), (None, "the quick brown fox jumps over the lazy dog."),
    (6, LONG), (7, LONG + " end"), (8, "Ünïcode ÀÉ 中文 😀 é"), (9, "one two"), (10, "ONE TWO"),
    (11, "<|endoftext|> it's 123 <|startoftext|>x"), (12, "\n\n\n"), (13, "x" * 50_000),
]


def documents(spark, rows=TEXTS):
    """Rows with extra columns whose names operators use inside."""
    return spark.createDataFrame(
        [(i, t, "fp", 1, "h", 2.0, "c", None) for i, t in rows],
        "doc_id long, text string, fp string, line int, text_hash string, score double, "
        "component string, id string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
