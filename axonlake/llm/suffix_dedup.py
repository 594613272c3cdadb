"""Removal of byte strings that an earlier document has: suffix sorting of the strings that more than one holds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import exchange
from .common import n_packs, ship
from .suffixes import sorted_suffixes

LENGTH = 50
#: A string's anchor is the least hash of its substrings of GRAM bytes.
GRAM = 20
PACK_BYTES = 4 << 20
CHUNK = 1 << 15
LAST = np.iinfo(np.int64).max


def _least_hashes(buf: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, np.ndarray]]:
    """(a, hashes): of the places p from a on, a chunk at a time, the least hash of the gram-byte strings within
    buf[p : p + length]."""
    n = len(buf) - length + 1
    code = np.random.default_rng(1).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    window, word = length - gram + 1, 2**64 - 1
    for a in range(0, n, CHUNK):
        z = min(n, a + CHUNK)
        part, one, mul, done, h = code[buf[a : z + length - 1]], 1, 0xD1342543DE82EF95, 0, None
        total = len(part)
        for bit in range(gram.bit_length()):
            if gram >> bit & 1:
                tail = part[done : done + total - done - one + 1]
                h = tail if h is None else h[: len(tail)] * np.uint64(mul) + tail
                done += one
            if gram >> bit + 1:
                part = part[:-one] * np.uint64(mul) + part[one:]
                one, mul = 2 * one, mul * mul & word
        h = h[: total - gram + 1]
        h = (h ^ h >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        one = 1
        while 2 * one <= window:
            h = np.minimum(h[:-one], h[one:])
            one *= 2
        if one < window:
            h = np.minimum(h[: len(h) - (window - one)], h[window - one :])
        yield a, h


def _spread(h: np.ndarray) -> np.ndarray:
    """Least hashes are small; a one-to-one mix spreads them over all owners."""
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(27)


class Pack:
    """A pack's documents in one buffer, ordered by doc_id and text, and their runs of strings with one anchor. Only the
    runs are held, not a number for each byte."""

    def __init__(self, t: pa.Table, length: int, gram: int):
        ids, texts = t.column("doc_id").to_pylist(), t.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (LAST if ids[k] is None else ids[k], texts[k] or ""))
        self.ids = [ids[k] for k in order]
        self.doc = np.array([LAST if d is None else d for d in self.ids], np.int64)
        raw = [(texts[k] or "").encode("utf-8", "surrogatepass") for k in order]
        del texts
        self.ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.bytes, self.length = b"".join(raw), length
        del raw
        self.buf = np.frombuffer(self.bytes, np.uint8)
        last_of = np.maximum(self.ends - length, self.starts - 1)  # last place of a string in each document
        firsts, hashes, before = [], [], np.uint64(0)
        for a, h in _least_hashes(self.buf, length, gram):
            lo, hi = np.searchsorted(self.ends, [a, a + len(h)], side="right")
            edge = np.zeros(len(h) + 1, np.int8)
            s, e = self.starts[lo : hi + 1], last_of[lo : hi + 1]
            real = e >= s
            np.add.at(edge, np.clip(s[real] - a, 0, len(h)), 1)
            np.add.at(edge, np.clip(e[real] + 1 - a, 0, len(h)), -1)
            valid = np.cumsum(edge[:-1], dtype=np.int8) > 0
            new = np.concatenate(([a == 0 or h[0] != before], h[1:] != h[:-1]))
            begin = self.starts[lo : hi + 1] - a
            new[begin[(begin >= 0) & (begin < len(h))]] = True
            at = np.flatnonzero(new & valid)
            firsts.append(at + a)
            hashes.append(_spread(h[at]))
            before = h[-1]
        self.first = np.concatenate([*firsts, np.zeros(0, np.int64)]).astype(np.int64)
        self.last = np.minimum(np.append(self.first[1:], len(self.buf)) - 1, last_of[self.docs_of()]) if len(self.first) else self.first
        self.hash, self.of = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_inverse=True)

    def docs_of(self) -> np.ndarray:
        """Number of the document of each run."""
        return np.searchsorted(self.ends, self.first, side="right")


def _key_bytes(packs: int) -> int:
    """Bytes of a hash that travel: so many that chance collisions, which only cost candidates, stay rare."""
    return 5 if packs <= 1 << 13 else 8


def _anchors(owners: int, length: int, gram: int):
    def ask(t: pa.Table) -> list[tuple[int, bytes]]:
        p = Pack(t, length, gram)
        doc, n = p.docs_of(), len(p.hash)
        lo, hi = np.full(n, LAST), np.full(n, -1)
        np.minimum.at(lo, p.of, doc)
        np.maximum.at(hi, p.of, doc)
        keys = p.hash.astype(">u8").view(np.uint8).reshape(-1, 8)[:, : _key_bytes(owners)]
        return [(k, np.array([z - a], "<u4").tobytes() + keys[a:z].tobytes() + np.packbits(lo[a:z] < hi[a:z]).tobytes()) for k, a, z in exchange.split(p.hash, owners)] or [(0, np.zeros(1, "<u4").tobytes())]

    return ask


def _shared(owners: int):
    """Which of each pack's anchors more than one document has, as bits in the pack's order."""
    width = _key_bytes(owners)

    def answer(packs: list[int], blobs: list[bytes]) -> list[bytes]:
        keys, often = [], []
        for b in blobs:
            n = int(np.frombuffer(b, "<u4", 1)[0])
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :width] = np.frombuffer(b, np.uint8, n * width, 4).reshape(n, width)
            keys.append(wide.view(">u8")[:, 0].astype(np.uint64))
            often.append(np.unpackbits(np.frombuffer(b, np.uint8, -1, 4 + n * width), count=n).astype(bool))
        every = np.concatenate(keys)
        order = np.argsort(every)
        s = every[order]
        new = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.zeros(0, bool)
        number = np.cumsum(new) - 1
        many = (np.bincount(number) > 1) | (np.bincount(number, weights=np.concatenate(often)[order]) > 0) if len(s) else np.zeros(0, bool)
        flags = np.empty(len(s), bool)
        flags[order] = many[number]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return [np.packbits(f).tobytes() + len(f).to_bytes(4, "little") for f in np.split(flags, cuts)]

    return answer


def _candidates(p: Pack, blobs: list[bytes]):
    """(run numbers, contents, content of each run, hash order of contents): the runs whose anchor is shared."""
    flags = np.concatenate([np.unpackbits(np.frombuffer(b[:-4], np.uint8), count=int.from_bytes(b[-4:], "little")) for b in blobs])
    runs = np.flatnonzero(flags[p.of]) if len(p.of) else np.zeros(0, np.int64)
    runs = runs[np.argsort(p.of[runs], kind="stable")]
    index: dict[bytes, int] = {}
    buf, extra = p.bytes, p.length
    which = np.fromiter((index.setdefault(buf[a : z + extra], len(index)) for a, z in zip(p.first[runs].tolist(), p.last[runs].tolist(), strict=True)), np.int64, len(runs))
    return runs, list(index), which


def _windows(owners: int, length: int, gram: int):
    def tell(t: pa.Table, blobs: list[bytes]) -> pa.Table:
        p = Pack(t, length, gram)
        runs, contents, which = _candidates(p, blobs)
        least = np.full(len(contents), LAST)
        np.minimum.at(least, which, p.doc[p.docs_of()[runs]])
        head = np.zeros(len(contents), np.uint64)
        head[which] = p.hash[p.of[runs]]
        sizes = np.fromiter(map(len, contents), "<u4", len(contents))
        pack, rows = t.column("pack")[0].as_py(), []
        for k, a, z in exchange.split(head, owners) or [(0, 0, 0)]:
            rows.append((pack, k, np.array([z - a], "<u4").tobytes() + least[a:z].astype("<i8").tobytes() + sizes[a:z].tobytes() + b"".join(contents[a:z])))
        return exchange._batch(rows)

    return tell


def _earliest(length: int):
    """For each content of each pack, runs (offset, places, doc_id): the smallest doc_id that holds the string there."""

    def answer(packs: list[int], blobs: list[bytes]) -> list[bytes]:
        index: dict[bytes, int] = {}
        which, least = [], []
        for b in blobs:
            n = int(np.frombuffer(b, "<u4", 1)[0])
            ends = np.cumsum(np.frombuffer(b, "<u4", n, 4 + 8 * n).astype(np.int64)) + 4 + 12 * n
            starts = np.concatenate(([4 + 12 * n], ends[:-1])) if n else ends
            which.append(np.fromiter((index.setdefault(b[s:e], len(index)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, n))
            least.append(np.frombuffer(b, "<i8", n, 4))
        doc = np.full(len(index), LAST)
        for w, d in zip(which, least, strict=True):
            np.minimum.at(doc, w, d)
        # bytes of UTF-8 are under 253, so two more fit: 1 ends a content, 0 the text
        text = np.frombuffer(b"\xff".join(index) + b"\xff\xfe", np.uint8) + np.uint8(2)
        sizes = np.fromiter(map(len, index), np.int64, len(index))
        begin = np.cumsum(sizes + 1) - sizes - 1
        n = int(sizes.sum()) + len(sizes)
        del index
        at_place = np.empty(n, np.int64)
        held, best = [], LAST  # places of the string that is not yet over, and its smallest doc_id
        for places, common in sorted_suffixes(text, length):
            real = places < n
            places, common = places[real], common[real]  # the end of the text comes first, so no prefix is lost
            docs = doc[np.searchsorted(begin, places, side="right") - 1]
            heads = np.flatnonzero(common < length)
            first = int(heads[0]) if len(heads) else len(places)
            held.append(places[:first])
            best = min(best, int(docs[:first].min())) if first else best
            if len(heads):
                at_place[np.concatenate(held)] = best
                least = np.minimum.reduceat(docs, heads)
                at_place[places[first:]] = np.repeat(least, np.diff(np.append(heads, len(places))))
                held, best = [places[heads[-1] :]], int(least[-1])
        if held:
            at_place[np.concatenate(held)] = best
        count = sizes - length + 1
        starts = _ragged(begin, count)
        found = at_place[starts]
        head = np.ones(len(starts), bool)
        head[1:] = found[1:] != found[:-1]
        edges = np.cumsum(count) - count
        head[edges] = True
        first = np.flatnonzero(head)
        run_doc, run_n = found[first], np.diff(np.append(first, len(starts)))
        per = np.add.reduceat(head.astype(np.int64), edges) if len(edges) else edges
        run_off = first - np.repeat(edges, per)
        run_at = np.cumsum(per) - per
        out = []
        for w in which:
            k = _ragged(run_at[w], per[w])
            out.append(np.array([len(w), len(k)], "<u4").tobytes() + per[w].astype("<u4").tobytes() + run_off[k].astype("<u4").tobytes() + run_n[k].astype("<u4").tobytes() + run_doc[k].astype("<i8").tobytes())
        return out

    return answer


def _ragged(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(begin - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _mark(length: int, gram: int, with_parts: bool):
    def tell(t: pa.Table, blobs: list[bytes]) -> pa.Table:
        shared = [b[1:] for b in blobs if b[:1] == b"a"]
        told = [b[1:] for b in blobs if b[:1] == b"b"]
        p = Pack(t, length, gram)
        runs, contents, which = _candidates(p, shared)
        parts = []
        for b in told:
            n, k = np.frombuffer(b, "<u4", 2).tolist()
            at = 8 + 4 * n
            parts.append((np.frombuffer(b, "<u4", n, 8).astype(np.int64), np.frombuffer(b, "<u4", k, at).astype(np.int64), np.frombuffer(b, "<u4", k, at + 4 * k).astype(np.int64), np.frombuffer(b, "<i8", k, at + 8 * k)))
        per, off, places, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
        k = _ragged((np.cumsum(per) - per)[which], per[which])
        run = np.repeat(runs, per[which])
        mine = p.docs_of()[run]
        earlier = doc[k] < p.doc[mine]
        start = (p.first[run] + off[k])[earlier]
        delta = np.zeros(len(p.buf) + 1, np.int32)
        np.add.at(delta, start, 1)
        np.add.at(delta, start + places[k][earlier] + length - 1, -1)
        np.cumsum(delta, out=delta)
        gone = delta[:-1] > 0
        del delta, k, run, mine, earlier, start, parts, per, off, places, doc, contents
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inside = p.starts[p.starts < len(gone)]
        opens[inside] = gone[inside]  # a span never goes on in the next document
        removed, spans = (np.concatenate(([0], np.cumsum(x, dtype=np.int32))) for x in (gone, opens))
        kept = p.buf[~gone].tobytes()
        at, cols, pieces, marks = 0, [], [], []
        for d, s, e in zip(p.ids, p.starts.tolist(), p.ends.tolist(), strict=True):
            n = int(removed[e] - removed[s])
            cols.append((d, e - s, n, int(spans[e] - spans[s]), hashlib.sha256(kept[at : at + e - s - n]).hexdigest()))
            if with_parts:
                pieces.append(kept[at : at + e - s - n])
                x = np.flatnonzero(np.diff(np.concatenate(([0], gone[s:e].astype(np.int8), [0]))))
                marks.append(x.tolist())
            at += e - s - n
        kinds = (pa.int64(),) * 4 + (pa.string(),)
        out = [pa.array([c[k] for c in cols], kinds[k]) for k in range(5)]
        names = [f.split()[0] for f in RESULT.split(", ")]
        if with_parts:
            out += [pa.array(pieces, pa.binary()), pa.array(marks, pa.list_(pa.int64()))]
            names += ["kept", "span_edges"]
        return pa.table(out, names)

    return tell


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, pack_bytes: int = PACK_BYTES, with_parts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): each document without the bytes that a string of length
    bytes covers which also starts in a document with a smaller doc_id. with_parts adds kept (the remaining bytes) and
    span_edges (start, end, start, end, ... of the removed spans, in bytes).

    1. Every string has an anchor, the least hash of its gram-byte substrings. Packs of documents ask the owners of
       hashes which anchors more than one document has; strings with another anchor have no copy.
    2. Runs of strings with a shared anchor go, each text once for a pack, to the anchor's owner. The owner sorts all
       suffixes of its texts by external induced sorting: queues of suffix tuples with their common prefixes, on disk
       beyond a set number. Suffixes that share length bytes are one string; its smallest doc_id goes back.
    3. Packs mark and cut. Matches never cross documents: no string of step 1 does.

    Texts are UTF-8 bytes. Null text is empty; a null doc_id comes after all others; rows with one doc_id don't remove
    from each other; an empty table gives no rows; other columns are ignored. A passage that a third of all documents
    hold reaches its owner once for each pack. The packs' texts are dealt out once and used three times.
    """
    ship(docs.sparkSession)
    n = n_packs(docs, pack_bytes)
    pk = exchange.packs(docs, n)
    shared = exchange.answered(exchange.asked(pk, _anchors(n, length, gram)), _shared(n))
    windows = exchange.told(pk, shared, _windows(n, length, gram), exchange.ASK)
    earliest = exchange.answered(windows, _earliest(length))
    both = exchange.tagged(shared, b"a").union(exchange.tagged(earliest, b"b"))
    schema = RESULT + (", kept binary, span_edges array<long>" if with_parts else "")
    return exchange.told(pk, both, _mark(length, gram, with_parts), schema)
