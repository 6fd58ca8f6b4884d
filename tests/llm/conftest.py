import random

import pytest

#: Names that operators use inside; callers' columns of these names must not matter.
CLASHES = ["key", "node", "n", "a", "b", "h", "size", "target", "tid", "uid", "digest", "start", "kh", "words", "hits", "payload", "bands", "_row", "_w", "body", "kept", "text2", "host", "tree"]


def prose(rng, n, lines=1):
    w = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]
    step = max(1, n // lines)
    return "\n".join(" ".join(w[i : i + step]) + "." for i in range(0, n, step))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, exact and near copies, shared passages."""
    rng = random.Random(5)
    base, passage = prose(rng, 300, 6), prose(rng, 90)
    near = base.split(" ")
    near[20] = near[200] = "changed"
    rows = [
        (1, base, "en", "s1", 1),
        (2, base, "en", "s2", 1),
        (3, " ".join(near), None, "s2", None),
        (4, None, "en", "s1", 1),
        (5, "", "en", "s1", 0),
        (6, " \n\t ", "en", None, 0),
        (7, prose(rng, 60) + "\n" + passage, "de", "é", 5),
        (8, prose(rng, 50) + "\n" + passage + "\n" + prose(rng, 40), "de", "s1", 5),
        (9, prose(rng, 30_000, 400), "en", "s1", 5),
        (10, prose(rng, 40, 3), "en", None, 5),
        (10, prose(rng, 45, 3), "en", None, 5),
        (11, prose(rng, 50, 2), "en", "s3", 5),
        (11, None, None, None, None),
        (None, prose(rng, 55, 2), "en", "s3", 5),
        (12, "one two three", "en", "s3", 5),
        (13, "日本語 テキスト é ² <|endoftext|> 's  x\r\n", "ja", "s3", 5),
        (14, "word " * 500, "en", "s3", 5),
        (15, "Accept cookies | Home | About | Contact | Login\nTHIS IS SHOUTED TEXT FOR ALL TO READ\n" + prose(rng, 40, 2), "en", "s3", 5),
    ]
    rows.append(rows[0])
    rows.append(rows[11])
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Those rows, with more columns that have clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in odd_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")
