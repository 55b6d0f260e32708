import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use for themselves
CLASHING = ("row", "id", "key", "hash", "body", "kept", "score", "size", "copies", "text_hash", "slot", "part", "rest", "node", "sig", "of_id")


def prose(seed, n, words=("alpha", "beta", "gamma", "delta", "omega", "river", "stone", "light", "paper", "cloud", "seven", "north")):
    """n words that depend on the seed."""
    out, state = [], seed * 2654435761 % (1 << 32)
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(words[(state >> 16) % len(words)] + str((state >> 8) % 97))
    return " ".join(out)


def edge_rows():
    long = prose(1, 30_000)
    near = prose(3, 300).split()
    changed = [*near]
    changed[150] = "changed"
    return [
        (1, None, "en", "src0", 0), (2, "", "en", "src0", 0), (3, "   \n\t ", None, None, 6), (None, "no id here", "en", "src1", 10),
        (None, None, None, None, None), (4, long, "en", "src0", len(long)), (5, long, "en", "src2", len(long)), (6, prose(2, 60), "de", "src1", 1),
        (6, prose(2, 60), "de", "src1", 1), (7, prose(2, 60), "de", None, 1), (8, "one two three", "en", "src0", 13), (9, "One TWO three", "en", "src0", 13),
        (10, " ".join(near), "en", "src3", 1), (11, " ".join(changed), "en", "src3", 1), (12, prose(2, 40) + " " + prose(9, 20), "en", "src3", 1),
        (13, "ß é 漢字 🙂 <|endoftext|> tail", "en", "src0", 1), (14, "same line\n" * 200, "en", "src0", 1), (-3, prose(12, 500), "en", "", 1),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows(), SCHEMA)
    return docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
