"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def whole_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``doc_id`` and ``text`` of a table, null text as empty.

    Whatever else the table holds, clashing names included, is left out.
    """
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """The words of a text in order, as an array."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def map_rows(
    schema: pa.Schema, rows: Callable[[Iterator[dict]], Iterator[dict]], size: int = 2000
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` from one that turns rows into rows.

    Rows come one at a time out of the Arrow batch, so that only the batch and one
    row's objects are in memory; results leave ``size`` rows at a time.
    """

    def run(batches):
        def incoming():
            for batch in batches:
                columns = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names)]
                for k in range(batch.num_rows):
                    yield {n: c[k].as_py() for n, c in columns}

        out = []
        for row in rows(incoming()):
            out.append(row)
            if len(out) >= size:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def prefix_sums(lengths: Column) -> Column:
    """Sums of all earlier elements for each element of an array of numbers.

    In two levels of blocks, so that the work grows with n ** 1.5 and not with n ** 2.
    """
    block = 256

    def running(values: Column) -> Column:
        return F.transform(
            values,
            lambda _, i: F.aggregate(F.slice(values, 1, i), F.lit(0), lambda a, x: a + x),
        )

    blocks = F.when(F.size(lengths) == 0, F.array(F.array().cast("array<int>"))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")),
            lambda b: F.slice(lengths, b * block + 1, F.lit(block)),
        )
    )
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    return F.flatten(
        F.zip_with(
            blocks, running(totals), lambda b, start: F.transform(running(b), lambda x: x + start)
        )
    )
