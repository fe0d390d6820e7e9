import base64
import hashlib
import os

import duckdb
import pytest

ID_TEXT = "doc_id long, text string"
#: A row of every awkward kind: null, empty, blank, tiny, repeated, with a null id, very long.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "a"),
    (5, "same words stand here twice and once more"),
    (6, "same words stand here twice and once more"),
    (6, "same words stand here twice and once more"),
    (None, "same words stand here twice and once more"),
    (8, "é👍 ünï\x00code \x85 end"),
    (9, "long " * 40_000 + "end"),
]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, ID_TEXT)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], ID_TEXT)


@pytest.fixture
def clashing(spark):
    """Extra columns with names that operators use themselves."""
    names = "ids bytes spans runs item_ids n_words score keep part extra cell root block check section posts".split()
    rows = [(i, f"document number {i} has a text", *range(len(names))) for i in range(5)]
    return spark.createDataFrame(rows, ID_TEXT + "".join(f", {n} int" for n in names))


@pytest.fixture(scope="session")
def con(sf):
    db = duckdb.connect()
    for name in os.listdir(sf):
        db.sql(f"create view {name.removesuffix('.parquet')} as select * from '{sf}/{name}'")
    return db


@pytest.fixture(scope="session")
def documents(con):
    return con.sql("select doc_id, text from documents order by doc_id").fetchall()


@pytest.fixture(scope="session")
def library():
    """The public library that encodes by the same ranks."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
