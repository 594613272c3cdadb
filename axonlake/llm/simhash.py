"""SimHash near-duplicate groups through a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_key, saved, ship, words_of
from .components import connected_components

SEED = 42
CHUNK = 1 << 15
#: A posting key of more fingerprints is split by one more byte, then into blocks of about so many.
HOT = 1 << 13


def fingerprint(text: str | None, width: int = 4) -> int:
    """64-bit SimHash over shingles of width words, repeats included; 0 for a text without words."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, ones, digest = len(words) - width + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        to = min(at + CHUNK, n)
        h = [digest(joined[s:e], SEED) for s, e in zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist(), strict=True)]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[str | None, int] = {}
            out = []
            for t in b.column("text").to_pylist():
                if t not in known:
                    known[t] = fingerprint(t, width)
                out.append(known[t])
            fp = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. Each document is one row; nothing is shuffled."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(width), "doc_id long, fp long")


def key_positions(max_bits: int) -> list[tuple[int, ...]]:
    """Byte positions whose posting lists are intersected. Fingerprints that differ in max_bits bits share 8 - max_bits
    positional bytes at least; every set of so many positions holds one of these tuples.

    For four shared bytes it is Turan's family of 20 triples, the smallest known; otherwise all tuples of at most three.
    """
    least = 8 - max_bits
    if least < 1:
        raise ValueError("max_bits must be under 8: otherwise no positional byte need be shared")
    if least == 4:
        parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
        inside = [p for p in parts if len(p) == 3]
        across = [tuple(sorted((*two, one))) for k, p in enumerate(parts) for two in combinations(p, 2) for one in parts[(k + 1) % 3]]
        return sorted(inside + across)
    return list(combinations(range(8), min(3, least)))


def _links(positions: list[tuple[int, ...]], max_bits: int):
    """Links within runs of equal keys; the rows of a partition come ordered by key."""
    agree = np.full(256, -1, np.int64)  # by the mask of equal bytes: the first tuple that it holds, which alone reports the pair
    for mask in range(256):
        agree[mask] = next((k for k, p in enumerate(positions) if all(mask >> x & 1 for x in p)), -1)

    def within(key: np.ndarray, fp: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
        parent = np.arange(len(key))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out, at, gap = [], np.arange(len(key)), 1
        while len(at):
            at = at[at + gap < len(key)]
            at = at[key[at] == key[at + gap]]
            left = at[parent[at] != parent[at + gap]]
            x = fp[left] ^ fp[left + gap]
            same = x.view(np.uint8).reshape(-1, 8) == 0
            tally = same.sum(axis=1)  # shared positional bytes
            keep = tally >= 8 - max_bits
            left, x, same = left[keep], x[keep], same[keep]
            mask = np.packbits(same, axis=1, bitorder="little")[:, 0] if len(left) else np.zeros(0, np.uint8)
            ok = (agree[mask] == key[left] >> 24 & 255) & (np.bitwise_count(x.view(np.uint64)) <= max_bits)
            for i in left[ok].tolist():  # a spanning forest of the links is enough, so the output is linear
                p, q = top(i), top(i + gap)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    out.append((int(root[i]), int(root[i + gap])))
            gap += 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def emit(cols):
            pairs = within(*cols)
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

        for b in batches:
            new = [b.column(n).to_numpy(zero_copy_only=False) for n in ("key", "fp", "root")]
            cols = new if held is None else [np.concatenate(p) for p in zip(held, new, strict=True)]
            if not len(cols[0]):
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last run may go on in the next batch
            yield emit([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield emit(held)

    return run


def _code(*parts):
    """A key of its own for the values of the parts, of which the first is a key: its tuple's number stays in place. Equal
    codes of different values would only have more pairs verified."""
    place = F.lit(255 << 24).cast("long")
    return F.xxhash64(*parts).bitwiseAND(F.bitwise_not(place)).bitwiseOR(parts[0].bitwiseAND(place))


def _split(postings: DataFrame, positions: list[tuple[int, ...]], max_bits: int, hot: int) -> DataFrame:
    """postings (key, fp, root) with no key of much more than hot fingerprints. Linked fingerprints share 8 - max_bits
    bytes, so if that is more than a key's own, the pairs of a large key share one more byte: its postings get a key for
    each other position and byte. A key that is still large is cut into blocks by hash, with a key for each two blocks."""

    def large(x: DataFrame) -> DataFrame:
        n = x.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot)
        return saved(n.select(F.col("key").alias("large"), F.ceil(F.col("n") / F.lit(hot)).alias("m")), "hot-keys")

    first = large(postings)
    if first.isEmpty():
        return postings
    cold = postings.join(first, F.col("key") == F.col("large"), "left_anti")
    x = postings.join(first, F.col("key") == F.col("large"))
    if 8 - max_bits > len(positions[0]):
        tuples = F.array(*(F.array(*(F.lit(p in t) for p in range(8))) for t in positions))
        own = F.element_at(tuples, (F.shiftright("key", 24).bitwiseAND(F.lit(255)) + 1).cast("int"))
        byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
        codes = F.array(*(F.when(~own[p], _code(F.col("key"), F.lit(p), byte(p))) for p in range(8)))
        x = saved(x.select(F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("key"), "fp", "root"), "split")
        second = large(x)
        cold = cold.union(x.join(second, F.col("key") == F.col("large"), "left_anti"))
        x = x.join(second, F.col("key") == F.col("large"))
    block = F.pmod(F.xxhash64("fp"), F.col("m"))
    x = x.select("key", "fp", "root", "m", block.alias("b")).select("key", "fp", "root", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("c"))
    return cold.union(x.select(_code(F.col("key"), F.least("b", "c"), F.greatest("b", "c")).alias("key"), "fp", "root"))


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4, hot: int = HOT) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents linked, directly or through others, by fingerprints that differ in
    at most max_bits bits; component_id is the smallest doc_id of the group.

    Method: the 8 bytes of a fingerprint are postings (position, byte). Two fingerprints within max_bits bits share at
    least 8 - max_bits postings, so intersections of posting lists at a few sets of positions meet every such pair; the
    shared positional bytes of a met pair are tallied, pairs under the guaranteed minimum dropped, and the rest verified
    by their bits. Copies are one entry of the index, so a large group of copies costs nothing; a large intersection
    gives a spanning forest of its links, never all pairs. A key of more than hot fingerprints is split over tasks by one
    more byte that its links share, and by pairs of blocks if that isn't enough; no link is lost.

    Null text is empty; texts without words have fingerprint 0 and link like others. Rows with a null doc_id keep a
    fingerprint and join by it. Repeated rows stay. No rows give no rows. Other columns are ignored.
    """
    fps = saved(fingerprints(docs, width), "fingerprints")
    index = fps.groupBy("fp").agg(F.min("doc_id").alias("root"))
    positions = key_positions(max_bits)

    def key(k: int, at: tuple[int, ...]):
        code = F.lit(k).cast("long")
        for x in at:
            code = F.shiftleft(code, 8).bitwiseOR(F.shiftrightunsigned("fp", 8 * x).bitwiseAND(F.lit(255)))
        return F.shiftleft(code, 8 * (3 - len(at))) if len(at) < 3 else code

    index = saved(index, "index")
    postings = index.where(F.col("root").isNotNull()).select(F.explode(F.array(*(key(k, p) for k, p in enumerate(positions)))).alias("key"), "fp", "root")
    links = _split(postings, positions, max_bits, hot).repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_links(positions, max_bits), "a long, b long")
    groups = connected_components(links)
    named = index.join(groups.hint("shuffle_merge"), F.col("root") == F.col("node"), "left").select(F.col("fp").alias("of"), F.coalesce("component", "root").alias("component_id"))
    return fps.join(named.hint("shuffle_merge"), F.col("fp").bitwiseXOR(F.lit(0)) == F.col("of").bitwiseXOR(F.lit(0)), "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Words of a wide fingerprint, which near copies at a word-set similarity are found by.
WIDE = 4
#: Bits by which two wide fingerprints may differ for each unit that the similarity allows, beyond what is expected.
SLACK = 1.2


def bits_at(similarity: float) -> int:
    """Bits that wide fingerprints of two equally large sets of that Jaccard similarity may differ by: the expected
    number, 64 WIDE times the angle between the sets over pi, and some slack for chance."""
    return int(SLACK * 64 * WIDE * np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def wide_fingerprint(text: str | None, width: int = 5) -> np.ndarray:
    """WIDE words of SimHash over the set of shingles of width words; zeros for a text without words."""
    words = words_of(text)
    if not words:
        return np.zeros(WIDE, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    shingles = {joined[s:e] for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)}
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64, len(shingles))
    out = np.zeros(WIDE, np.uint64)
    for at in range(WIDE):
        ones = np.zeros(64, np.int64)
        for a in range(0, len(h), CHUNK):
            x = h[a : a + CHUNK] + np.uint64(at * 0x9E3779B97F4A7C15 & 2**64 - 1)
            x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
            ones += np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[at] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out


def _wide_fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[str | None, np.ndarray] = {}
            rows = []
            for t in b.column("text").to_pylist():
                if t not in known:
                    known[t] = wide_fingerprint(t, width)
                rows.append(known[t])
            w = np.array(rows, np.uint64).reshape(-1, WIDE).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.ascontiguousarray(w[:, k])) for k in range(WIDE))], ["doc_id", *(f"w{k}" for k in range(WIDE))])

    return run


def _similar(max_bits: int):
    """Links within runs of equal keys, as _links, for wide fingerprints."""

    def within(key: np.ndarray, root: np.ndarray, words: list[np.ndarray]) -> list[tuple[int, int]]:
        parent = np.arange(len(key))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out, at, gap = [], np.arange(len(key)), 1
        while len(at):
            at = at[at + gap < len(key)]
            at = at[key[at] == key[at + gap]]
            left = at[parent[at] != parent[at + gap]]
            d = np.zeros(len(left), np.int64)
            for w in words:
                d += np.bitwise_count((w[left] ^ w[left + gap]).view(np.uint64))
            for i in left[d <= max_bits].tolist():
                p, q = top(i), top(i + gap)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    out.append((int(root[i]), int(root[i + gap])))
            gap += 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def emit(cols):
            pairs = within(cols[0], cols[1], cols[2:])
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

        for b in batches:
            new = [b.column(k).to_numpy(zero_copy_only=False) for k in range(2 + WIDE)]
            cols = new if held is None else [np.concatenate(p) for p in zip(held, new, strict=True)]
            if not len(cols[0]):
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            yield emit([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None:
            yield emit(held)

    return run


def similar_documents(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id): groups of documents whose sets of shingles are alike to at least similarity (Jaccard), as
    wide fingerprints tell; component_id is the smallest doc_id of the group.

    At such a similarity fingerprints differ in many bits, so no number of shared bytes is sure. The 8 WIDE positional
    bytes are taken word by word; posting lists are intersected at the pairs of positions within each word, which meets
    pairs that share two bytes of a word (99 of 100 at 0.8, nearly all above), and a met pair is verified by all its
    bits: at most bits_at(similarity) may differ. Copies, large intersections, nulls and ties are as in
    near_duplicates(). Documents without words are alike.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [f"w{k}" for k in range(WIDE)]
    fps = saved(rows.mapInArrow(_wide_fingerprints(width), "doc_id long, " + ", ".join(f"{n} long" for n in names)), "wide")
    index = saved(fps.groupBy(*names).agg(F.min("doc_id").alias("root")).where("root IS NOT NULL"), "wide-index")
    byte = lambda n, x: F.shiftrightunsigned(n, 8 * x).bitwiseAND(F.lit(255))
    keys, k = [], 0
    for n in names:
        for x, y in combinations(range(8), 2):
            keys.append(F.lit(k << 16).cast("long").bitwiseOR(F.shiftleft(byte(n, x), 8)).bitwiseOR(byte(n, y)))
            k += 1
    postings = index.select(F.explode(F.array(*keys)).alias("key"), "root", *names)
    links = postings.repartition("key").sortWithinPartitions("key", "root").mapInArrow(_similar(bits_at(similarity)), "a long, b long")
    groups = connected_components(links)
    named = index.join(groups.hint("shuffle_merge"), F.col("root") == F.col("node"), "left").select(*(F.col(n).alias(f"_{n}") for n in names), F.coalesce("component", "root").alias("component_id"))
    same = [F.col(n).bitwiseXOR(F.lit(0)) == F.col(f"_{n}").bitwiseXOR(F.lit(0)) for n in names]
    return fps.join(named.hint("shuffle_merge"), same, "left").select("doc_id", "component_id")


def first_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of docs for each group of similar_documents(), with all its columns: the document with the smallest
    doc_id. Of rows with one doc_id one stays; rows with a null doc_id count as one document, which is never a copy."""
    key, own = fresh(docs, "_key", "_id")
    groups = similar_documents(docs, width, similarity)
    first = groups.where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).select(id_key().alias(own)).distinct()
    x = docs.withColumn(key, id_key())
    return x.join(first.hint("shuffle_merge"), F.col(key) == F.col(own), "left_semi").dropDuplicates([key]).drop(key)
