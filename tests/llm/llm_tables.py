"""Rows and tables of the corpus tests."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Awkward rows: null ids and texts, empty texts, repeats, one long text, texts of one word or none.
LONG = " ".join(f"word{i % 997} rest{i % 131}" for i in range(30_000))
SHARED = "This passage of well over fifty bytes stands in several of the documents, word for word."
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from all of it", "en", "a"),
    (2, None, "en", "a"), (3, "", "de", "a"), (4, "   \n\t ", "fr", None), (5, LONG, "en", "a"),
    (6, "one", None, "b"), (7, "one", None, "b"), (8, SHARED + " First ending here.", "en", "a"),
    (9, "Another start. " + SHARED, "en", "a"), (10, "!!! 123 ???", "es", "b"), (11, "été à Noël — où?", "fr", "b"),
    (12, "the Quick brown  FOX jumps over the lazy dog and runs away from all of it", "en", "a"),
    (13, "aaaaaaaaaa" * 40, None, None), (14, "aaaaaaaaaa" * 30, None, None), (15, "日本語のテキスト", None, "b"),
    (12, "the Quick brown  FOX jumps over the lazy dog and runs away from all of it", "en", "a"),
    (None, "The quick brown fox jumps over the lazy dog and runs away from all of it", "en", "a"),
    (None, None, None, None),
]

SF_DIR = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")
