"""Quality rules: per-document counts and cross-document line frequency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_key, saved, ship

#: A line is boilerplate in a host if it stands in more than MIN_DOCS documents there and in more than SHARE of the host's.
MIN_DOCS, SHARE = 20, 0.0005
#: A document is depleted if less than KEPT of its words is left without boilerplate lines.
KEPT = 0.3
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, host string, " + ", ".join(f"{s} long" for s in STATS) + ", whole long, lines array<long>, line_words array<int>"


def _repeat_words(ids: np.ndarray) -> int:
    """Words in 3-word windows that stand twice or more in the text."""
    n = len(ids) - 2
    if n < 2:
        return 0
    a = ids[:n].astype(np.uint64) << np.uint64(42) | ids[1 : n + 1].astype(np.uint64) << np.uint64(21) | ids[2:].astype(np.uint64)
    if ids.max() >= 1 << 21:  # too many words for one key
        _, a = np.unique(np.stack([ids[:n], ids[1 : n + 1], ids[2:]]), axis=1, return_inverse=True)
    order = np.argsort(a, kind="stable")
    s = a[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    for k in range(3):
        covered[k : n + k] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[list[int], int, list[int], list[int]]:
    """The five counts; a hash of all normalised lines that hold a word; a hash of each; its words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, seen, duplicates = [], set(), 0
    lines, sizes = [], []
    for line in raw.split(b"\n"):
        own = line.split()
        if own:
            words += own
            duplicates += line in seen
            seen.add(line)
            lines.append(xxhash.xxh64_intdigest(b" ".join(own).lower()) - (1 << 63))
            sizes.append(len(own))
    whole = xxhash.xxh64_intdigest(np.array(lines, np.int64).tobytes()) - (1 << 63)
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    chars = len(raw) - sum(raw.count(bytes([c])) for c in b" \t\n\x0b\x0c\r")
    if not raw.isascii():
        chars -= int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80))
    return [len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), duplicates, _repeat_words(ids)], whole, lines, sizes


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            rows = [measure(t) for t in part.column("text").to_pylist()]
            stats = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(5)]
            lists = [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("host"), *stats, *lists], names)


def judged(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE, least_kept: float = KEPT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, kept_words, base_failed, kept) of each row.

    base_failed: under 50 words, or more than half of them in repeated 3-word windows. Else the verdict is by line
    frequency: lines are normalised (A-Z lower, white space runs to one space) and hashed; within each host the
    documents that hold a line are counted, documents whose lines are all the same as one, so copies of a document don't
    make its own lines boilerplate. Lines over both limits are removed; a document is rejected if less
    than least_kept of its words is left.

    Null text has no words and fails; a null host is a host; repeated rows are judged each; an empty table stays empty;
    other columns are ignored. Only line hashes move: they are made distinct before the count, and a line that a third
    of all documents hold is one row for each document that adaptive execution may split.
    """
    ship(docs.sparkSession)
    x = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    seen = saved(x.mapInArrow(_measure, SCHEMA).withColumn("row", F.monotonically_increasing_id()), "lines")
    sizes = seen.groupBy("host").agg(F.count("*").alias("host_docs"))
    lines = seen.select("row", "host", "whole", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select("row", "host", "whole", F.xxhash64(F.coalesce("host", F.lit("")), F.col("host").isNull(), "l.lines").alias("line"), F.col("l.line_words").alias("words"))
    often = lines.groupBy("host", "line", "whole").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
    often = often.join(sizes, often["host"].eqNullSafe(sizes["host"])).where(F.col("n") > share * F.col("host_docs")).select(F.col("line").bitwiseXOR(F.lit(0)).alias("of")).distinct()
    removed = lines.join(often.hint("shuffle_merge"), F.col("line").bitwiseXOR(F.lit(0)) == F.col("of").bitwiseXOR(F.lit(0)), "left_semi").groupBy("row").agg(F.sum("words").alias("removed"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    y = seen.drop("lines", "whole", "line_words", "host").join(removed.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return y.select("doc_id", *STATS, left.alias("kept_words"), failed.alias("base_failed"), (~failed & (left >= least_kept * F.col("n_words"))).alias("kept"))


def kept_documents(docs: DataFrame, **limits) -> DataFrame:
    """The rows of docs that judged() keeps, by doc_id, with all their columns; rows of one doc_id go or stay together
    (they stay if any of them is kept). Rows with a null doc_id count as one document."""
    (key,) = fresh(docs, "_id")
    good = judged(docs, **limits).where("kept").select(id_key().alias(key)).distinct()
    return docs.join(good.hint("shuffle_merge"), id_key() == F.col(key), "left_semi")
