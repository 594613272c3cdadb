import hashlib
import random

from axonlake.llm import suffix_dedup

from .helpers import corpus, docs


def slow(texts, length):
    raw = [(t or "").encode() for t in texts]
    first = {}
    for d, b in enumerate(raw):
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], d)
    out = {}
    for d, b in enumerate(raw):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < d:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def planted():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(25) for _ in range(4)]
    out = [text(r.randrange(5, 60)) for _ in range(40)]
    for k in range(12):
        p = r.choice(passages)
        out.append(text(4) + p[: r.randrange(40, len(p))] + text(3) + r.choice(passages))
    out += ["ab" * 120, "xab" + "ab" * 60, "a" * 49, "a" * 50, "a" * 51, out[0], out[0] + "z", out[1][:-1], "\x00" * 60, "q\x00" + "\x00" * 60, passages[0] * 3]
    return out


def test_matches_brute_force(spark):
    for texts in (planted(), corpus()):
        got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.deduplicated(docs(spark, texts), pack_bytes=1500).collect()}
        assert got == slow(texts, 50)


def test_parts_and_edges(spark):
    texts = ["x" * 10 + "0123456789" * 6, "0123456789" * 6 + "tail"]
    got = {r.doc_id: r for r in suffix_dedup.deduplicated(docs(spark, texts), with_parts=True).collect()}
    assert bytes(got[1].kept) == b"tail" and got[1].span_edges == [0, 60] and got[0].n_removed == 0
    assert suffix_dedup.deduplicated(docs(spark, [])).collect() == []
