"""Rows that every operator must take."""

EDGES = [
    (1, "Plain words, and a few more of them here.\nA second line with its own words.", "en", "a", 10, "x"),
    (1, "Plain words, and a few more of them here.\nA second line with its own words.", "en", "a", 10, "x"),
    (2, None, None, None, None, None),
    (3, "", "en", "", 0, ""),
    (None, "no id at all but some text that is long enough to count", "fr", "b", 5, "y"),
    (None, None, None, None, None, None),
    (4, " \t\n \x0b\x0c\r ", "en", "a", 7, "z"),
    (5, "word " * 30_000, "en", "hot", 1, None),
    (6, "ünï çödé 日本語 \U0001f600 <|endoftext|> don't  two  blanks", "de", "hot", 1, None),
    (7, "x" * 50_000, None, "hot", 1, None),
    (-8, "a\x00b \x1c c\x85d", "en", "hot", 1, None),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, `size` string, "
          "`score` double, `row` int, `doc` string, `odd name.with``signs` string, label int, n array<int>")


def edge_documents(spark):
    rows = [(*r[:5], r[5], None, 3, "d", "q", 1, [1]) for r in EDGES]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)
