import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from axonlake.llm import packing, tokens

from .helpers import corpus, docs

ODD = ["a  b", " lead", "trail ", "tab\t x", "x\n y", "x \ny", "a  b", "a  b", " ", "it's I'm 12 345", "a\n\nb  \n c", "Σας ΣΑΣ", "é ́x", "İstanbul", "", None, " ", "日本 語。 ok", "x\x1c y", "x \x85y", "a <|endoftext|> b", "<|startoftext|>x<|ENDOFTEXT|>", "c <| d<|endoftext|>", "<|endoftext"]


@functools.cache
def tokenizer(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids_of(name, text):
    return tokenizer(name).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_equal_the_tokenizer(name, spaced, monkeypatch):
    texts = corpus() + ODD
    r = __import__("random").Random(1)
    letters = "aBcé Éñ.,'sStLl12²½ª_-#@\n\t\xa0×÷ßœŒ  "
    texts += ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(400)]
    want = [ids_of(name, t) for t in texts]
    for limit in (10**6, 3):
        monkeypatch.setattr(tokens, "CACHE_PIECES", limit)
        monkeypatch.setattr(tokens, "CACHE_WORDS", limit)
        e = tokens.PieceEncoder(public_tokenizers.path(name), spaced)
        for _ in range(2):
            assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == want


def test_blocks_round_trip():
    r = np.random.default_rng(0)
    for x in (np.zeros(0), np.full(3, 7), r.integers(0, 50_000, 1300), np.r_[r.integers(5, 9, 511), 2**32 - 1], r.integers(0, 2**32, 2000)):
        x = x.astype(np.uint32)
        index, payload = tokens.pack_blocks(x)
        data, n = np.frombuffer(payload, np.uint8), -(-len(x) // tokens.BLOCK)
        assert np.array_equal(tokens.unpack_blocks(index, data, 0, n)[: len(x)], x)
        for k in range(n):
            assert np.array_equal(tokens.unpack_blocks(index, data, k, k + 1)[: len(x) - k * tokens.BLOCK], x[k * tokens.BLOCK : (k + 1) * tokens.BLOCK])
    f = tokens.TokenFile(tokens.write_file([(4, np.arange(700, dtype="<u4")), (None, np.array([9], "<u4"))]))
    assert f.ids(510, 514).tolist() == [510, 511, 512, 513] and f.doc_ids == [4, None]


def test_files_hold_every_id_in_order(spark):
    texts = corpus() + ODD
    files = tokens.write_ids(docs(spark, texts), public_tokenizers.path("byte_bpe_50k.json"), file_ids=300, part_bytes=2000)
    got = sorted(tuple(r) for r in tokens.read_ids(files).collect())
    want, at = [], 0
    for i, t in enumerate(texts):
        ids = [*ids_of("byte_bpe_50k.json", t), 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert tokens.read_ids(tokens.write_ids(docs(spark, []), public_tokenizers.path("byte_bpe_50k.json"))).collect() == []


def check_packing(rows, want, size):
    by_doc, by_seq = {}, {}
    for d, start, length, crc, total, seq, offset in rows:
        by_doc.setdefault(d, []).append((start, length, crc, total))
        by_seq.setdefault(seq, []).append((offset, length))
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        at = 0
        for start, length, crc, total in sorted(pieces):
            assert start == at and length > 0 and total == len(want[d])
            assert crc == zlib.crc32(np.array(want[d][start : start + length], "<u4").tobytes())
            at += length
        assert at == len(want[d])
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packer_places_every_id_once():
    r = np.random.default_rng(2)
    p, want, rows = packing.Packer(64), {}, []
    for d in range(500):
        ids = r.integers(0, 9, int(r.integers(1, 150))).astype("<u4")
        want[d] = ids.tolist()
        rows.extend(p.add(d, ids))
        if d == 300:
            rows.extend(p.merge())
            assert p.held == 0
    rows.extend(p.merge())
    assert check_packing(rows, want, 64) == 0


def slow_level(levels, r, size):
    """The level whose window a piece of r goes to (0: a new window): every choice's sum of squares, ties to the fullest."""
    best = None
    for h in range(size - r + 1):
        if h and not levels[h]:
            continue
        after = dict(enumerate(levels))
        if h:
            after[h] -= 1
        if h + r < size:
            after[h + r] += 1
        cost = sum(v * v for k, v in after.items() if 0 < k < size)
        if best is None or cost <= best[0]:
            best = (cost, h)
    return best[1]


def test_packer_follows_the_sum_of_squares():
    r = np.random.default_rng(4)
    for top in (20, 40, 63):
        p, levels = packing.Packer(32), [0] * 33
        for d in range(400):
            n = int(r.integers(1, top))
            list(p.add(d, np.zeros(n, "<u4")))
            if n % 32:
                h = slow_level(levels, n % 32, 32)
                levels[h] -= h > 0
                levels[h + n % 32] += h + n % 32 < 32
            assert p.levels[1:32].tolist() == levels[1:32]


def test_packing_of_documents(spark):
    texts = corpus() + ODD
    rows = [tuple(r) for r in packing.packed(docs(spark, texts), public_tokenizers.path("word_bpe_49k.json"), size=256).collect()]
    assert check_packing(rows, {i: [*ids_of("word_bpe_49k.json", t), 2] for i, t in enumerate(texts)}, 256) == 0
    assert packing.packed(docs(spark, []), public_tokenizers.path("word_bpe_49k.json")).collect() == []


def test_a_packing_worker_keeps_few_ids(monkeypatch):
    """The caches of a packing task are bounded by KNOWN, and ids are the same when they are full."""
    path, texts = public_tokenizers.path("word_bpe_49k.json"), [" ".join(f"w{i}x{k}q" for k in range(40)) for i in range(30)]
    monkeypatch.setattr(packing, "KNOWN", 50)
    monkeypatch.setattr(tokens, "_encoders", {})
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    batch = pa.RecordBatch.from_arrays([pa.array(range(30), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    rows = [r for b in packing._pack(path, False, 2, 256)(iter([batch])) for r in b.to_pylist()]
    (encoder,) = tokens._encoders.values()
    assert len(encoder.known) == 50 and len(encoder.words) <= 50
    want = {i: [*ids_of("word_bpe_49k.json", t), 2] for i, t in enumerate(texts)}
    assert check_packing([tuple(r.values()) for r in rows], want, 256) == 0
