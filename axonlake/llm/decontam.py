"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_key, saved, ship, words_of

#: Words of a seed. An inserted word breaks one window of two words, and a missing one two.
SEED = 2
#: A longer item is cut into passages of so many words, of which any copy counts.
MOST_WORDS = 2000
SIMILARITY = 0.8
#: Bits that the matched words must carry (a word's: -log2 of its share of the corpus's words); an item's copy with fewer
#: is told from chance only where it stands as whole lines.
EVIDENCE = 40
#: A block of items that goes to every executor has so many bytes of text at most.
BLOCK_BYTES = 8 << 20
#: Alignments made at once.
LANES = 512


def tokens_of(text: str | None) -> list[bytes]:
    """Words in lower case without punctuation at their ends, those that are all punctuation left out."""
    out = (w.strip(b".,;:!?\"'()[]{}*#%&$|<>-_") for w in words_of(text))
    return [w for w in out if w]


def edits(n: int, similarity: float) -> int:
    """The most words of an item of n words that a copy of that similarity lacks."""
    return n - int(np.ceil(similarity * n - 1e-9))


def least_score(n: int, similarity: float) -> int:
    """Twice the least score of a copy of an item of n words: that of one with a share of 1 - similarity of them replaced.
    Items of one or two words must be whole."""
    return 2 * n if n < 3 else int(np.ceil(n * (3 * similarity - 1) - 1e-9))


class Items:
    """A block of test items: word numbers, the items' words as numbers, and the n-grams that may be seeds."""

    def __init__(self, rows: list[tuple[int, str | None]], similarity: float):
        self.similarity, self.words, self.items, self.ids = similarity, {}, {}, {}
        for k, (item, text) in enumerate(rows):
            if w := tokens_of(text):
                self.items[k], self.ids[k] = np.array([self.words.setdefault(x, len(self.words)) for x in w], np.int64), item
        self.known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(self.keys(w) for w in self.items.values())]))
        self.bits = self.seeds = self.starts = self.owners = None
        self.weak: dict[tuple[int, ...], list[int]] = {}

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.words.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def keys(self, w: np.ndarray) -> np.ndarray:
        """Of each window of SEED words, in order; unknown words give 2 ** 64 - 1."""
        n = max(0, len(w) - SEED + 1)
        k, bad = np.zeros(n, np.uint64), np.zeros(n, bool)
        for i in range(SEED):
            x = w[i : i + n]
            bad |= x < 0
            k = k * np.uint64(len(self.words) + 1) + (x + 1).astype(np.uint64)
        k[bad] = np.uint64(2**64 - 1)
        return k

    def hits(self, w: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, indices) of the n-grams of a document that are among the given sorted ones."""
        k = self.keys(w)
        if not len(among) or not len(k):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i = np.minimum(np.searchsorted(among, k), len(among) - 1)
        ok = among[i] == k
        return np.flatnonzero(ok), i[ok]

    def choose(self, counts: np.ndarray) -> None:
        """Seeds and bits from the counts of _count. A copy loses half a point for each window that it breaks at least (an
        inserted word one and half a point, a missing or replaced one two and three halves, one cut off an end one and two
        halves), so of one more windows than it may lose half points it has one; the rarest are taken."""
        grams, words, total = counts[: len(self.known)], counts[len(self.known) : -1], max(1, int(counts[-1]))
        self.bits = np.round(-np.log2(np.maximum(words, 1) / total)).astype(np.int64)
        seeds, owners = [], []
        for item, w in self.items.items():
            if self.bits[w].sum() < EVIDENCE or len(w) < SEED:
                self.weak.setdefault(tuple(w.tolist()), []).append(item)
                continue
            k = self.keys(w)
            n = grams[np.searchsorted(self.known, k)]
            mine = np.unique(k[np.argsort(n, kind="stable")[: 2 * len(w) - least_score(len(w), self.similarity) + 1]])
            seeds.append(mine)
            owners.append(np.full(len(mine), item))
        k, o = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((seeds, np.uint64), (owners, np.int64)))
        order = np.lexsort((o, k))
        self.owners = o[order]
        self.seeds, first = np.unique(k[order], return_index=True)
        self.starts = np.append(first, len(k))

    def spots(self, w: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(item, places of its seeds in a document, in order)."""
        at, i = self.hits(w, self.seeds)
        many = self.starts[i + 1] - self.starts[i]
        ends = np.cumsum(many)
        if not len(ends):
            return
        each = np.repeat(self.starts[i] - ends + many, many) + np.arange(ends[-1])
        item, at = self.owners[each], np.repeat(at, many)
        order = np.argsort(item, kind="stable")
        item, at = item[order], at[order]
        cuts = np.flatnonzero(np.diff(item)) + 1
        for x, y in zip(np.append(0, cuts), np.append(cuts, len(item)), strict=True):
            yield int(item[x]), at[x:y]

    def pieces(self, item: int, w: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(place, words) around the seeds of an item that hold enough of its words close together for a copy. Windows
        that touch are taken together, long ones in overlapping pieces."""
        x = self.items[item]
        n = len(x)
        reach = 3 * n - least_score(n, self.similarity) + SEED  # a copy and the words put into it
        near = np.isin(w[max(0, at[0] - reach) : at[-1] + reach], x)
        for group in np.split(at, np.flatnonzero(np.diff(at) > 2 * reach) + 1):
            lo, hi = max(0, int(group[0]) - reach), min(len(w), int(group[-1]) + reach)
            for a in range(lo, hi, 4 * reach):
                z = min(hi, a + 6 * reach)
                from_ = max(0, int(at[0]) - reach)
                held = np.append(0, np.cumsum(near[a - from_ : z - from_]))
                if (held[reach:] - held[:-reach] if len(held) > reach else held[-1:]).max() >= n - edits(n, self.similarity):
                    yield a, w[a:z]
                if z == hi:
                    break

    def whole_lines(self, text: str, w: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, place) of the weak items that stand as whole lines."""
        if not self.weak:
            return
        ends = np.cumsum([0] + [len(tokens_of(x)) for x in text.split("\n")]).tolist()
        edges, lengths, heads = set(ends), {len(k) for k in self.weak}, {k[0] for k in self.weak}
        for a in sorted(edges):
            if a < len(w) and w[a] in heads:
                for n in lengths:
                    if a + n in edges:
                        for item in self.weak.get(tuple(w[a : a + n].tolist()), ()):
                            yield item, a


def align(item: np.ndarray, windows: np.ndarray, bits: np.ndarray | None = None) -> np.ndarray:
    """Smith-Waterman: the best local alignment of item with each row of windows (-2: nothing), as (twice the score,
    matched words, first, last, bits of the matched words by the item's words). A match is worth 1, a mismatch or gap
    costs 0.5. Rows of the matrix are computed for all windows at once; matches and bits travel with the score in one
    integer and the start beside it, so ties take more matches, then more bits."""
    n, m = windows.shape
    unit, step = np.int64(1 << 40), np.int64(1 << 20)
    bits = np.zeros(len(item), np.int64) if bits is None else bits
    score, start = np.zeros((n, m + 1), np.int64), np.tile(np.arange(m + 1), (n, 1))
    best, first, last = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    lanes, columns = np.arange(n), np.arange(m + 1)
    for w, bit in zip(item.tolist(), bits.tolist(), strict=True):
        hit = windows == w
        diag = score[:, :-1] + np.where(hit, 2 * unit + step + bit, -unit)
        up = score[:, 1:] - unit
        new, from_ = np.zeros_like(score), np.tile(columns, (n, 1))
        take = diag >= up
        value = np.where(take, diag, up)
        source = np.where(take, start[:, :-1], start[:, 1:])
        ok = value > 0
        new[:, 1:] = np.where(ok, value, 0)
        from_[:, 1:] = np.where(ok, source, columns[1:])
        # gaps along the window: a running maximum of value + column * unit
        lifted = new + columns * unit
        top = np.maximum.accumulate(lifted, axis=1)
        where = np.maximum.accumulate(np.where(lifted == top, columns, 0), axis=1)
        score = top - columns * unit
        start = np.take_along_axis(from_, where, axis=1)
        score = np.maximum(score, 0)
        start = np.where(score > 0, start, columns)
        at = score.argmax(axis=1)
        s = score[lanes, at]
        better = s > best
        best[better], first[better], last[better] = s[better], start[lanes, at][better], at[better]
    return np.stack([best // unit, best % unit // step, first, last, best % step], axis=1)


def _count(items: Items):
    """(index, n): documents that hold each known n-gram, then how often each known word occurs, then all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, total = np.zeros(len(items.known), np.int64), np.zeros(len(items.words), np.int64), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                w = items.numbers(tokens_of(t))
                total += len(w)
                which, n = np.unique(w[w >= 0], return_counts=True)
                words[which] += n
                grams[np.unique(items.hits(w, items.known)[1])] += 1
        n = np.concatenate([grams, words, [total]])
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int64)), pa.array(n[has])], ["index", "n"])

    return run


RESULT = "doc_id long, item_id long, similarity double, score double, first_word long, last_word long, evidence long"


def _match(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lanes: dict[int, list[tuple[int | None, int, np.ndarray]]] = defaultdict(list)
            out: list[tuple] = []

            def flush(item):
                rows, w = lanes.pop(item), items.items[item]
                wide = np.full((len(rows), max(len(r[2]) for r in rows)), -2, np.int64)
                for k, r in enumerate(rows):
                    wide[k, : len(r[2])] = r[2]
                least, most = least_score(len(w), items.similarity), edits(len(w), items.similarity)
                for (d, at, _), (score, matched, first, last, bits) in zip(rows, align(w, wide, items.bits[w]).tolist(), strict=True):
                    if score >= least and matched >= len(w) - most and bits >= EVIDENCE:
                        out.append((d, items.ids[item], matched / len(w), score / 2, at + first, at + last - 1, bits))

            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = items.numbers(tokens_of(t))
                for item, at in items.whole_lines(t or "", w):
                    n = len(items.items[item])
                    out.append((d, items.ids[item], 1.0, float(n), at, at + n - 1, int(items.bits[items.items[item]].sum())))
                for item, places in items.spots(w):
                    lanes[item] += [(d, at, piece) for at, piece in items.pieces(item, w, places)]
                    if len(lanes[item]) >= LANES:
                        flush(item)
            for item in [k for k, v in lanes.items() if v]:
                flush(item)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64() if k not in (2, 3) else pa.float64()) for k in range(7)], ["doc_id", "item_id", "similarity", "score", "first_word", "last_word", "evidence"])

    return run


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items as passages of at most MOST_WORDS words, of like length."""
    for b in batches:
        rows = []
        for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            w = tokens_of(text)
            n = -(-len(w) // MOST_WORDS)
            cuts = [len(w) * k // n for k in range(n + 1)] if n else []
            rows += [(item, b" ".join(w[a:z]).decode("utf-8", "replace")) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["item_id", "text"])


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, score, first_word, last_word, evidence): documents that hold a copy of a test item;
    the best place for each document and item.

    Words are lower case without punctuation at the ends. Smith-Waterman aligns the item with the words around a seed (a
    match 1, a word put in, left out or replaced -0.5). A copy has the score of one with a share of 1 - similarity of its
    words replaced, so words put in between count against it by half, and at least similarity of the words matched in
    order. Their evidence (bits: -log2 of a word's share of all words of the corpus) must reach EVIDENCE, so some common
    words in a row are no copy. An item with less evidence as a whole, such as a short one, or of one word is a copy where it stands word
    for word as whole lines. Seeds join documents to items: each item's rarest 2-word windows, by the number of documents
    of the whole corpus that hold them, as many as make sure that every copy has one.

    The items go to the executors in blocks of at most BLOCK_BYTES, however many there are; the corpus is never
    shuffled. Null texts and items hold nothing, nor do items without a word; items of over MOST_WORDS words are cut into
    passages of like length, a copy of any of which counts (the best is reported); repeated rows report once for each
    doc_id; no rows on either side give none; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    tests = saved(tests.mapInArrow(_passages, "item_id long, text string"), "passages")
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // (BLOCK_BYTES // 2))
    out = spark.createDataFrame([], RESULT)
    for k in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        block = [tuple(r) for r in mine.select("item_id", "text").toLocalIterator()]  # about half of BLOCK_BYTES
        items = Items(block, similarity)
        counts = rows.select("text").mapInArrow(_count(items), "index long, n long").groupBy("index").agg(F.sum("n").alias("n"))
        n = np.zeros(len(items.known) + len(items.words) + 1, np.int64)
        for r in counts.toLocalIterator():  # one number for each n-gram and word of the block
            n[r["index"]] = r["n"]
        items.choose(n)
        out = out.union(rows.mapInArrow(_match(items), RESULT))
    best = F.max(F.struct("similarity", "score", F.negative("first_word").alias("f"), "last_word", "evidence")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.similarity", "b.score", F.negative("b.f").alias("first_word"), "b.last_word", "b.evidence")


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs without a copy of a test item, with all their columns. Rows of one doc_id go or stay together;
    those with a null doc_id count as one document."""
    (key,) = fresh(docs, "_id")
    bad = saved(contaminated(docs, benchmark, similarity).select(id_key().alias(key)).distinct(), "contaminated")
    return docs.join(bad, id_key() == F.col(key), "left_anti")
