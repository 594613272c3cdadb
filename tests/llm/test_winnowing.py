"""Winnowing against a plain version, and its guarantee."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from axonlake.llm import queries as Q
from axonlake.llm import winnowing
from axonlake.llm.winnowing import BASE, PRIME, K, W

from .helpers import corpus, docs


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def slow(text):
    """[(place, hash)], window by window."""
    ws = [w.lower().encode() for w in re.findall("[!-⹿]{1,64}|[^\t-\r ]", text or "")]
    if not ws:
        return []

    def wide(p):
        x = 42
        for w in ws[p : p + K]:
            x = xxhash.xxh64_intdigest(w, seed=x)
        return p, signed(x)

    if len(ws) < K:
        return [wide(0)]
    hs = []
    for i in range(len(ws) - K + 1):
        x = 0
        for w in ws[i : i + K]:
            x = (x * BASE + (xxhash.xxh64_intdigest(w, seed=42) & ((1 << 30) - 1))) % PRIME
        hs.append(x)
    out = []
    for s in range(max(1, len(hs) - W + 1)):
        p = min(range(s, min(s + W, len(hs))), key=lambda i: (hs[i], -i))
        if not out or out[-1] != p:
            out.append(p)
    return [wide(p) for p in out]


def likeness(a, b):
    x, y = {e[1] for e in a}, {e[1] for e in b}
    return len(x & y) / len(x | y) if x | y else 1.0


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    return [[tuple(e) for e in r.f] for r in df.select("i", winnowing.fingerprint(F.col("text")).alias("f")).orderBy("i").collect()]


ODD = ["東京は日本の首都であり、世界最大の都市圏を形成している。", "a" * 1000 + " b " + "é" * 70, "one two three four", "same " * 300, "x y z \x00\x01 q", "😀 " * 30]


def test_against_brute_force(spark):
    texts = corpus(3, 40) + ODD
    assert prints(spark, texts) == [slow(t) for t in texts]


@pytest.mark.parametrize("limit", [0, 200])
def test_pieces_change_nothing(spark, monkeypatch, limit):
    texts = corpus(4, 30) + ODD
    want = [slow(t) for t in texts]
    piece = 32
    monkeypatch.setattr(winnowing, "LONG", limit)
    monkeypatch.setattr(winnowing, "PIECE", piece)
    monkeypatch.setattr(winnowing, "PIECES", winnowing.PIECES.replace(str((1 << 16) + W + K - 2), str(piece + W + K - 2)).replace(str(1 << 16), str(piece)))
    assert prints(spark, texts) == want


def test_very_long_text(spark):
    r = random.Random(1)
    text = " ".join(str(r.randrange(10_000)) for _ in range(300_000))
    assert len(text) > winnowing.LONG
    assert prints(spark, [text]) == [slow(text)]


def test_guarantee(spark):
    r = random.Random(5)
    word = lambda: f"w{r.randrange(10**6)}"
    passage = [word() for _ in range(W + K - 1)]
    texts = [" ".join([word() for _ in range(k)] + passage + [word() for _ in range(40 - k)]) for k in range(0, 40, 3)]
    hashes = [{h for _, h in f} for f in prints(spark, texts)]
    assert set.intersection(*hashes)


def expected(rows):
    """rows (doc_id, text), no two alike."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5((r[1] or "").encode()).hexdigest()))
    out = {}
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        a, b, c = slow(t), slow(edited), slow(after)
        text = lambda f: ",".join(f"{p}:{h % (1 << 64):x}" for p, h in f)
        out[i, hashlib.sha256((t or "").encode()).hexdigest()] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), likeness(a, b), likeness(a, c))
    return out


def found(spark, folder, df):
    df.write.parquet(f"{folder}/documents.parquet")
    x = Q.op12_winnowing_fingerprints(spark, str(folder))
    assert x.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r) for r in x.collect()), key=str)


@pytest.mark.parametrize("limit", [1 << 20, 150])
def test_query(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(winnowing, "LONG", limit)
    texts = corpus(6, 50) + ODD
    want = sorted(((i, *v) for (i, _), v in expected(list(enumerate(texts))).items()), key=str)
    assert found(spark, tmp_path, docs(spark, texts)) == want


def test_odd_rows(spark, tmp_path):
    rows = [(None, "a b c d e f g"), (None, None), (None, "Q" * 90), (3, "one two"), (3, "one three"), (-2, "")]
    df = spark.createDataFrame([(*r, "k", 1) for r in [*rows, rows[3], rows[0], rows[0]]], "doc_id long, text string, h string, c int")
    want = [(i, *v) for (i, _), v in expected(rows).items()]
    want += [x for x in want if x[2] in {v[1] for (i, s), v in expected(rows).items() if (i, s) == (3, hashlib.sha256(b"one two").hexdigest())}]
    want += [x for x in want if x[0] is None and x[1] == 13] * 2
    assert found(spark, tmp_path, df) == sorted(want, key=str)


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, tmp_path, n):
    got = found(spark, tmp_path, docs(spark, ["alpha beta gamma delta epsilon zeta eta theta iota"]).limit(n))
    assert len(got) == n and all(r[-1] == 1.0 for r in got)
