"""Corpus queries beside their DuckDB SQL: on given tables and on awkward ones."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from clickloom.llm.licenses import NOTICES
from clickloom.llm.queries import ORACLES, QUERIES


def both(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    want = db.sql(ORACLES[name])
    columns = sorted(want.columns)
    wanted = [tuple(r) for r in want.select(*columns).fetchall()]
    found = QUERIES[name](spark, str(folder))
    assert sorted(found.columns) == columns
    rows = [tuple(r) for r in found.select(*columns).collect()]
    return sorted(wanted, key=repr), sorted(rows, key=repr)


@pytest.fixture(scope="module")
def awkward(tmp_path_factory):
    folder = tmp_path_factory.mktemp("awkward")
    line = "one two three four five six seven eight nine ten"
    texts = [
        None,
        "",
        " \t\n\n ",
        line,
        f"{line}\n{line} eleven\nshort",
        line.replace("ten", "TEN"),
        line.replace("ten", "x").replace("one", "y"),
        "short\n short \n\x0bshort",
        NOTICES[0][1] + " " + NOTICES[6][1],
        "don't stop " + NOTICES[9][1].upper() + " tail" * 40,
        " ".join(NOTICES[2][1].split()[2:]),
    ]
    ids = [*range(len(texts)), 3]
    n = len(ids)
    docs = pa.table({
        "doc_id": pa.array([*ids[:-2], None, ids[-1]], pa.int64()),
        "text": pa.array([*texts, line]),
        "lang": pa.array(["en", None, "é"] * n)[:n],
        "source": pa.array(["hot", "hot", None, "", "Z", "é"] * n)[:n],
        "n_chars": pa.array([None, *range(n - 1)], pa.int64()),
    })
    pq.write_table(docs, folder / "documents.parquet")
    vectors = [
        (0, [0.5, -0.25, 0.001]),
        (0, [0.5, -0.25, 0.001]),
        (50, [1.0]),
        (1, [0.5, -0.25, 0.001]),
        (2, [0.5, -0.25, 0.001, 4.0]),
        (3, None),
        (4, [float("nan"), 1.0]),
        (5, [float("-inf")]),
        (6, [None, 1.0]),
        (None, [1.0, 2.0]),
        (100, []),
        (7, [-0.5, 1e6]),
    ]
    ids, values = zip(*vectors, strict=True)
    table = {"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(values, pa.list_(pa.float32()))}
    pq.write_table(pa.table(table), folder / "embeddings.parquet")
    return folder


@pytest.mark.parametrize("name", ORACLES)
def test_given_tables(spark, name):
    wanted, found = both(spark, "/root/testdata/sf0.001", name)
    assert wanted and found == wanted


@pytest.mark.parametrize("name", ORACLES)
def test_awkward_tables(spark, awkward, name):
    wanted, found = both(spark, awkward, name)
    assert wanted and found == wanted
