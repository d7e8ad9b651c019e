import random

import pytest

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use themselves.
CLASHING = ("score", "fp", "ids", "spans", "block", "size", "label", "chunk", "pair", "digest", "first", "_kept_key", "shard", "row_number")


def make_docs(spark, rows, extra=True):
    """documents from (doc_id, text) pairs, with columns that clash with the operators' own."""
    names = CLASHING if extra else ()
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint" + "".join(f", {c} string" for c in names)
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), *("x" for _ in names)) for i, t in rows], ddl)


@pytest.fixture(scope="session")
def words():
    r = random.Random(5)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randint(1, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def edge_rows(words):
    """Null and empty texts, null and repeated ids, repeated rows, odd characters, a long text."""
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 120)))) for i in range(40)]
    long = " ".join(r.choice(words) for _ in range(40_000))
    return rows + [(100, None), (101, ""), (102, " \n\t "), (None, "no id at all"), (None, None), (7, "another text of seven"), rows[3],
                   rows[3], (103, long), (104, "漢字 😀 é́   İ ſ K"), (105, "x" * 70_000), (106, " " * 70_000 + "y"),
                   (107, rows[5][1]), (108, rows[5][1] + " more")]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return make_docs(spark, edge_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])


def rows_of(df):
    """Rows as sortable tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
