"""Documents with every awkward case, for the tests of this folder."""

SMALL = "/root/testdata/sf0.001"

EXTRA = "score double, key_1 string, node int, n int, size string, row int, of_doc int, grp string, toxic2 int"
DOCUMENTS = f"doc_id bigint, text string, lang string, source string, n_chars int, {EXTRA}"
FILL = (0.5, "k", 1, 2, "s", 3, 4, "g", 5)

PLAIN = "The quick brown fox jumps over the lazy dog while the old cat sleeps on the warm mat near the door."
OTHER = "Der schnelle braune Fuchs springt ueber den faulen Hund, und die alte Katze schlaeft auf der Matte."


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source]) with extra columns named like inner ones."""
    full = [(*row, *(["en", "a"][len(row) - 2 :]), 1, *FILL) for row in rows]
    return spark.createDataFrame(full, DOCUMENTS)


AWKWARD = [
    (1, PLAIN),
    (1, PLAIN),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "..."),
    (None, PLAIN),
    (None, None),
    (6, PLAIN, None, None),
    (7, OTHER, "de", None),
    (8, (PLAIN + " ") * 3000),
    (9, "ÀÉÎ \U0001f600 naïve 日本語 text"),
    (10, "a"),
    (11, "x" * 200_000),
]
