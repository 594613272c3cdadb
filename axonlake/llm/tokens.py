"""Token ids: a piece cache in front of a public tokenizer, and files of patched frame-of-reference blocks."""

from __future__ import annotations

import struct
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_packs, saved, ship

#: A worker's caches hold so many pieces and words at most; beyond that new ones are encoded anew each time.
CACHE_PIECES, CACHE_WORDS = 700_000, 1_000_000
BLOCK = 512
PERCENTILE = 95
MAGIC = b"AXT1"
#: How the two kinds of tokenizer cut a text into words.
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters below this are cut, lowered and normalised alike by every Unicode version.
STABLE = "\u0130"
assert array("I").itemsize == 4 and sys.byteorder == "little"
_encoders: dict[tuple[str, bool, int | None], PieceEncoder] = {}


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else the next above 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class _Odd(Exception):
    """A piece that can't be told apart from its neighbours."""


class _Pieces(dict):
    """Ids of pieces; a missing one is encoded on the spot and kept while there is room."""

    def __init__(self, encoder: PieceEncoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        if self.encoder.spaced and (not piece or piece[0].isspace() or piece[-1].isspace()):
            raise _Odd
        ids = self.encoder.piece(" " + piece if self.encoder.spaced else piece)
        if len(self) < self.encoder.most[0]:
            self[piece] = ids
        return ids


class PieceEncoder:
    """Ids of whole texts, equal to the tokenizer's own, at a dictionary look-up a word.

    A text is cut at single spaces. Neither tokenizer kind merges across such a space: byte-level ones (spaced=True) put
    it in front of the next piece, word-end ones drop it. A piece that begins or ends with white space, or is empty,
    would break this for byte-level ones; such a text goes to the tokenizer whole. A new piece is cut into the words that
    the tokenizer cuts, and only new words go to its model; a piece with a character from STABLE on goes to the
    tokenizer itself. So does a text that holds the first two characters of a special token, as the tokenizer finds those
    before it cuts. The caches hold CACHE_PIECES pieces and CACHE_WORDS words at most, or most of each.
    """

    def __init__(self, path: str, spaced: bool, most: int | None = None):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        self.marks = {t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.spaced, self.known, self.words = spaced, _Pieces(self), {}
        self.most = (CACHE_PIECES, CACHE_WORDS) if most is None else (most, most)
        self.cut = regex.compile(BYTE_WORDS if spaced else END_WORDS).findall
        self.letters = dict(enumerate(byte_letters()))

    @classmethod
    def of(cls, path: str, spaced: bool, most: int | None = None) -> PieceEncoder:
        if (path, spaced, most) not in _encoders:
            _encoders[path, spaced, most] = cls(path, spaced, most)
        return _encoders[path, spaced, most]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        if piece and max(piece) >= STABLE:
            return self.whole(piece)
        known, out = self.words, []
        for w in self.cut(piece if self.spaced else piece.lower()):
            x = known.get(w)
            if x is None:
                letters = "".join(map(self.letters.__getitem__, w.encode()))
                x = array("I", [t.id for t in self.model(letters)]).tobytes()
                if len(known) < self.most[1]:
                    known[w] = x
            out.append(x)
        return b"".join(out)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; null is the empty text."""
        out, get = [], self.known.__getitem__
        for t in texts:
            cut = (t or "").split(" ")
            head = cut[0]
            try:
                if t and any(m in t for m in self.marks):
                    raise _Odd
                if self.spaced and head[-1:].isspace():
                    raise _Odd
                cut[0] = self.piece(head)
                cut[1:] = map(get, cut[1:])
                out.append(b"".join(cut))
            except _Odd:
                out.append(self.whole(t or ""))
        return out


def encoded(batches: Iterator[pa.RecordBatch], path: str, spaced: bool, end: int, chunk_chars: int = 1_000_000, most: int | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids with the end id) of each row, in order, a bounded number of characters at a time."""
    encoder, last = PieceEncoder.of(path, spaced, most), np.array([end], "<u4").tobytes()
    for b in batches:
        ids, texts, at = b.column("doc_id").to_pylist(), b.column("text"), 0
        lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        edges = np.searchsorted(np.cumsum(lengths), np.arange(chunk_chars, lengths.sum() + chunk_chars, chunk_chars), side="right") + 1
        for to in dict.fromkeys([*np.minimum(edges, len(ids)).tolist(), len(ids)]):
            if to > at:
                for d, x in zip(ids[at:to], encoder.encode(texts.slice(at, to - at).to_pylist()), strict=True):
                    yield d, np.frombuffer(x + last, "<u4")
                at = to


def pack_blocks(ids: np.ndarray) -> tuple[dict[str, np.ndarray], bytes]:
    """(index, payload). Each block of BLOCK ids is its minimum (low), a width that holds PERCENTILE per cent of the
    differences, the packed low bits at its start in the payload, and a list of exceptions: places in the block and high
    bits, where first counts the exceptions of the blocks before."""
    full = -(-len(ids) // BLOCK)
    x = np.concatenate([ids, np.full(full * BLOCK - len(ids), ids[-1] if len(ids) else 0)]).astype(np.uint32).reshape(full, BLOCK)
    low = x.min(axis=1) if full else np.zeros(0, np.uint32)
    rest = x - low[:, None]
    cut = np.partition(rest, BLOCK * PERCENTILE // 100, axis=1)[:, BLOCK * PERCENTILE // 100] if full else low
    width = np.ceil(np.log2(cut.astype(np.float64) + 1)).astype(np.uint8)
    sizes = width.astype(np.int64) * (BLOCK // 8)
    start = np.cumsum(sizes) - sizes
    payload = np.zeros(int(sizes.sum()), np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        bits = np.unpackbits(rest[which].astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - w :]
        payload[start[which][:, None] + np.arange(w * BLOCK // 8)] = np.packbits(bits.reshape(len(which), -1), axis=1)
    high = np.where(width[:, None] < 32, rest >> np.minimum(width, 31)[:, None].astype(np.uint32), 0)
    block, place = np.nonzero(high)
    first = np.searchsorted(block, np.arange(full))
    index = {"low": low.astype("<u4"), "width": width, "start": start.astype("<u8"), "first": first.astype("<u8"), "place": place.astype("<u2"), "high": high[block, place].astype("<u4")}
    return index, payload.tobytes()


def unpack_blocks(index: dict[str, np.ndarray], payload: np.ndarray, a: int, z: int) -> np.ndarray:
    """The ids of blocks a to z - 1; only their bytes and exceptions are read."""
    low, width, start = index["low"][a:z], index["width"][a:z], index["start"][a:z].astype(np.int64)
    x = np.zeros((z - a, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        bits = np.unpackbits(payload[start[which][:, None] + np.arange(w * BLOCK // 8)], axis=1).reshape(-1, w)
        wide = np.zeros((len(bits), 32), np.uint8)
        wide[:, 32 - w :] = bits
        x[which] = np.packbits(wide, axis=1).view(">u4").reshape(len(which), BLOCK)
    first = index["first"].astype(np.int64)
    s, e = (int(first[k]) if k < len(first) else len(index["place"]) for k in (a, z))
    block = np.repeat(np.arange(a, z), np.diff(np.append(first[a:z], e))) - a
    x[block, index["place"][s:e]] |= index["high"][s:e] << width[block].astype(np.uint32)
    return (x + low[:, None]).reshape(-1)


def write_file(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """A file: magic; numbers of documents, ids, blocks and exceptions; doc_ids, null flags and id counts; the block
    index (minimum, width, start, first exception); exceptions (places, high bits); packed blocks."""
    ids = np.concatenate([x for _, x in docs])
    index, payload = pack_blocks(ids)
    names = np.array([0 if d is None else d for d, _ in docs], "<i8")
    nulls = np.array([d is None for d, _ in docs], np.uint8)
    counts = np.array([len(x) for _, x in docs], "<u8")
    head = struct.pack("<QQQQ", len(docs), len(ids), len(index["low"]), len(index["place"]))
    return b"".join([MAGIC, head, names.tobytes(), nulls.tobytes(), counts.tobytes(), *(index[n].tobytes() for n in index), payload])


class TokenFile:
    """Reads a file of write_file; ids(first, last) touches only the blocks that hold them."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        n, self.n_ids, blocks, more = struct.unpack_from("<QQQQ", data, 4)
        at = 36

        def take(kind, count):
            nonlocal at
            x = np.frombuffer(data, kind, count, at)
            at += x.nbytes
            return x

        names, nulls = take("<i8", n), take(np.uint8, n)
        self.doc_ids = [None if z else d for d, z in zip(names.tolist(), nulls.tolist(), strict=True)]
        self.counts = take("<u8", n).astype(np.int64)
        kinds = {"low": "<u4", "width": np.uint8, "start": "<u8", "first": "<u8", "place": "<u2", "high": "<u4"}
        self.index = {k: take(t, blocks if k in ("low", "width", "start", "first") else more) for k, t in kinds.items()}
        self.payload = np.frombuffer(data, np.uint8, offset=at)

    def ids(self, first: int, last: int) -> np.ndarray:
        a, z = first // BLOCK, -(-last // BLOCK)
        return unpack_blocks(self.index, self.payload, a, z)[first - a * BLOCK : last - a * BLOCK] if z > a else np.zeros(0, np.uint32)

    def documents(self, run: int = 1 << 18) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the file, ids), decoding about run ids at a time."""
        ends = np.cumsum(self.counts)
        starts, k = ends - self.counts, 0
        while k < len(ends):
            to = max(k + 1, int(np.searchsorted(ends, starts[k] + run, side="right")))
            ids = self.ids(int(starts[k]), int(ends[to - 1]))
            for i in range(k, to):
                yield self.doc_ids[i], int(starts[i]), ids[starts[i] - starts[k] : ends[i] - starts[k]]
            k = to


FILES = "part int, seq int, n_docs long, n_ids long, data binary"


def _to_files(path: str, spaced: bool, end: int, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def file():
            cols = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([n], pa.int64()), pa.array([write_file(held)], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, ["part", "seq", "n_docs", "n_ids", "data"])

        for d, ids in encoded(batches, path, spaced, end):
            held.append((d, ids))
            n += len(ids)
            if n >= file_ids:
                yield file()
                seq, held, n = seq + 1, [], 0
        if held:
            yield file()

    return run


def write_ids(docs: DataFrame, path: str, spaced: bool = True, end: int = 0, file_ids: int = 2_000_000, part_bytes: int = 16 << 20) -> DataFrame:
    """Token files in ascending doc_id order (null first, ties by text), a row each: part, seq, n_docs, n_ids, data.

    Texts are dealt out by doc_id ranges, so each task writes one run of the order and (part, seq) sorts the files. The
    files are binary cells of a table in the shared folder, which any store of Spark's holds. Null text gives the end id
    alone; an empty table gives no file; other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(n_packs(rows, part_bytes), "doc_id").sortWithinPartitions("doc_id", "text")
    return saved(ordered.mapInArrow(_to_files(path, spaced, end, file_ids), FILES), "token-files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, seq, data in zip(b.column("part").to_pylist(), b.column("seq").to_pylist(), b.column("data"), strict=True):
            rows = [(d, s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, s, x in TokenFile(data.as_py()).documents()]
            cols = [pa.array([part] * len(rows), pa.int32()), pa.array([seq] * len(rows), pa.int32()), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4))]
            yield pa.RecordBatch.from_arrays(cols, ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the files: start counts the ids of all documents before it.

    Only counts are joined: one row for each file is summed up in order, then meets the files' narrow document rows.
    """
    ship(files.sparkSession)
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.select(F.col("part").alias("p"), F.col("seq").alias("s"), before.alias("before"))
    x = files.select("part", "seq", "data").mapInArrow(_read, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return x.join(starts, (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s"))).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
