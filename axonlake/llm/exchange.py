"""Questions and answers between packs of documents and owners of hashed keys, as binary cells.

A pack is a bounded group of documents; an owner holds the keys of one hash range. Packs ask (owner, blob), owners
answer (pack, blob). Each message holds what numpy has already made distinct, so a key reaches its owner once for each
pack however often it occurs: a key that a third of all rows hold is no hot group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASK = "pack long, owner long, blob binary"


def packs(docs: DataFrame, n: int) -> DataFrame:
    """(pack, doc_id, text), dealt out by a hash of doc_id and text; null doc_ids are spread by their text."""
    d, t = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(F.pmod(F.xxhash64(d, F.when(d.isNull(), t)), F.lit(n)).alias("pack"), d.alias("doc_id"), t.alias("text"))


def rows_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["pack", "owner", "blob"])


def _batch(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([rows_of(rows)])


def split(hashes: np.ndarray, owners: int) -> list[tuple[int, int, int]]:
    """(owner, first, last) runs of sorted unsigned 64-bit hashes, by equal ranges of the hash (of its first 32 bits).
    There are as many runs as owners that hold a hash, so messages never outnumber the hashes."""
    if not len(hashes):
        return []
    owner = (hashes >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return list(zip(owner[first].tolist(), first.tolist(), [*first[1:].tolist(), len(hashes)], strict=True))


def asked(docs: DataFrame, ask: Callable[[pa.Table], list[tuple[int, bytes]]]) -> DataFrame:
    """What each pack asks: ask gets a pack's table and returns (owner, blob) pairs."""

    def run(t: pa.Table) -> pa.Table:
        pack = t.column("pack")[0].as_py()
        return _batch([(pack, owner, blob) for owner, blob in ask(t)])

    return docs.groupBy("pack").applyInArrow(run, ASK)


def answered(questions: DataFrame, answer: Callable[[list[int], list[bytes]], list[bytes]]) -> DataFrame:
    """What each owner answers: answer gets the asking packs in order and their blobs, and returns a blob for each."""

    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("pack").to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        who, owner = t.column("pack").to_pylist(), t.column("owner")[0].as_py()
        return _batch([(p, owner, b) for p, b in zip(who, answer(who, t.column("blob").to_pylist()), strict=True)])

    return questions.groupBy("owner").applyInArrow(run, ASK)


def told(docs: DataFrame, answers: DataFrame, tell: Callable[[pa.Table, list[bytes]], pa.Table], schema: str) -> DataFrame:
    """Each pack's result: tell gets its table and the answers' blobs in the owners' order."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.take(pa.array(np.argsort(right.column("owner").to_numpy(), kind="stable")))
        return tell(left, right.column("blob").to_pylist())

    return docs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(run, schema)


def tagged(answers: DataFrame, tag: bytes) -> DataFrame:
    """answers whose blobs begin with a byte that tells them from others."""
    return answers.select("pack", "owner", F.concat(F.lit(bytearray(tag)), "blob").alias("blob"))
