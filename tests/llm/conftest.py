import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def odd_rows():
    """Nulls in every column, empty, blank, very long and repeated texts,
    ties, repeated rows."""
    words = "the quick brown fox jumps over the lazy dog and runs far away from here to there".split()
    long = " ".join(words[i % len(words)] + str(i % 97) for i in range(40_000))
    near = " ".join(f"w{i}" for i in range(60))
    return [
        (1, "Hello World, this is a small text for you.", "en", "a", 1),
        (2, "hello world,\tthis is a small\ntext for you.", "en", "a", 2),
        (3, "Hello  World, this is a small text for you. ", "en", None, 3),
        (4, None, "en", "b", None), (5, "", None, "b", 0), (6, " \t\n\x0b\x0c\r ", "de", None, 7),
        (7, "12345 !!! 999", "de", "c", 3), (8, "eins", "de", "c", 4), (9, "Eins", None, "c", 4),
        (10, near, "en", "d", 5), (11, near + " more", "en", "d", 5), (12, near.replace("w30 ", "x "), "en", "d", 5),
        (13, near, "fr", "e", 5), (14, long, "fr", "e", 9), (15, "漢字かな交じり文 😀 é É ß", "ja", "f", 9),
        (15, "漢字かな交じり文 😀 é É ß", "ja", "f", 9),
        (None, "row without an id", "en", "g", 1), (None, None, None, None, None),
        (16, "mail bob.smith+x@mail.example.com or 10.20.30.40, 4111 1111 1111 1111, +1 (415) 555-2671", "en", "g", 1),
        (17, "a <|endoftext|> b <|startoftext|>", "en", "g", 1), (20, "un deux trois quatre cinq six", "fr", "h", 1),
        (25, "un deux trois quatre cinq six", "fr", "h", 1),
    ]


# Names that operators use for columns of their own.
CLASH = ("size", "u", "n", "node", "comp", "rep", "bucket", "batch", "length", "sha", "score", "times", "below", "copies",
         "__dup", "__near", "__mix_source", "__mix_copies", "__mix_copiest", "__mix_copiesb", "__mix_times", "__sha", "__shas",
         "__gone_sha", "__lang_kept", "x", "key", "Prefix")


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F
    d = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    return d.select("*", *[F.lit("?").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
