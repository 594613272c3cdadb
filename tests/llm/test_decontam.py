import random
from collections import Counter

import numpy as np

from axonlake.llm import decontam

from .helpers import docs


def slow_align(item, w):
    """Best local alignment by plain dynamic programming: (score, matched)."""
    best = (0.0, 0)
    prev = [(0.0, 0)] * (len(w) + 1)
    for x in item:
        row = [(0.0, 0)]
        for j, y in enumerate(w, 1):
            s, m = prev[j - 1]
            d = (s + 1, m + 1) if x == y else (s - 0.5, m)
            c = max((0.0, 0), d, (prev[j][0] - 0.5, prev[j][1]), (row[j - 1][0] - 0.5, row[j - 1][1]))
            row.append(c)
        best = max([best, *row])
        prev = row
    return best


def test_alignment_matches_plain_dynamic_programming():
    r = np.random.default_rng(4)
    for _ in range(60):
        item = r.integers(0, 6, int(r.integers(1, 14)))
        w = r.integers(0, 6, (5, int(r.integers(1, 25))))
        got = decontam.align(item, w)
        for k in range(5):
            assert (got[k, 0] / 2, got[k, 1]) == slow_align(item.tolist(), w[k].tolist())


def test_copies_edits_and_clean_documents(spark):
    r = random.Random(7)
    vocab = [f"{a}{b}" for a in ("ba", "co", "di", "fu", "ga", "hel") for b in ("ran", "sto", "tive", "um", "ver", "wix")]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [text(n) for n in (40, 25, 15, 60)] + ["two words", None, "..."]
    texts, want = [], set()
    for k in range(4):
        w = items[k].split()
        texts.append(text(30) + " " + items[k].upper() + ". " + text(50))
        want.add((len(texts) - 1, k))
        for _ in range(6):  # edited copies: a tenth of the words replaced or dropped, some added
            e = list(w)
            for i in r.sample(range(len(e)), len(e) // 10):
                e[i] = r.choice(["zzz", ""])
            e.insert(len(e) // 2, "added")
            texts.append(text(100) + " " + " ".join(e) + " " + text(20))
            want.add((len(texts) - 1, k))
        texts.append(" ".join(w[: len(w) // 2]) + " " + text(40))
    texts += [None, "", text(2000) + " " + items[0] + " " + text(2000), "say two words now", text(300)]
    want |= {(len(texts) - 3, 0)}
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(docs(spark, texts), bench).collect()}
    assert got == want
    left = {x.doc_id for x in decontam.clean_documents(docs(spark, texts), bench).collect()}
    assert left == set(range(len(texts))) - {d for d, _ in want}


def test_edges(spark):
    bench = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert decontam.contaminated(docs(spark, []), bench).collect() == []
    assert decontam.contaminated(docs(spark, ["a b c d e"]), bench.limit(0)).collect() == []


def test_short_and_very_long_items(spark):
    r = random.Random(9)
    text = lambda n: " ".join(f"q{r.randrange(5000)}" for _ in range(n))
    long = text(7001)
    bench = spark.createDataFrame([(1, "yes"), (2, "no way"), (3, long), (4, "one two three four five")], "item_id long, text string")
    texts = ["yes no way", "yes it is no way", text(50) + " " + " ".join(long.split()[5300:7001]) + " x", " ".join(long.split()[:300]), "a one, two three; Four five b", long]
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(docs(spark, texts), bench).collect()}
    assert got == {(2, 3), (4, 4), (5, 3)}


def test_clashing_columns(spark):
    bench = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    x = docs(spark, ["a b c d e", "clean text"]).selectExpr("*", "1 AS _id", "2 AS _key", "3 AS item_id")
    y = decontam.clean_documents(x, bench)
    assert y.columns == x.columns and [tuple(r)[-3:] for r in y.collect()] == [(1, 2, 3)]


def brute_force(texts, items, similarity=0.8):
    """(doc, item) by aligning every item with every whole document, without seeds or windows."""
    words = [decontam.tokens_of(t) for t in texts]
    count = Counter(x for w in words for x in w)
    total, number = sum(count.values()), {}
    out = set()
    for i, text in enumerate(items):
        item = decontam.tokens_of(text)
        bits = np.array([round(-np.log2(max(1, count[x]) / total)) for x in item], np.int64)
        x = np.array([number.setdefault(v, len(number)) for v in item], np.int64)
        for d, t in enumerate(texts):
            lines = [decontam.tokens_of(v) for v in (t or "").split("\n")]
            if item and (bits.sum() < decontam.EVIDENCE or len(item) == 1):
                if any(sum(lines[a:z], []) == item for a in range(len(lines)) for z in range(a + 1, len(lines) + 1)):
                    out.add((d, i))
            elif item and words[d]:
                w = np.array([[number.get(v, -1) for v in words[d]]], np.int64)
                score, matched, _, _, got = decontam.align(x, w, bits)[0]
                if score / 2 >= (1.5 * similarity - 0.5) * len(item) - 1e-9 and matched >= similarity * len(item) - 1e-9 and got >= decontam.EVIDENCE:
                    out.add((d, i))
    return out


def edited(r, w, kind, fresh):
    """A copy with a fifth of its words replaced, left out or moved off an end, or with words put in."""
    n, w = len(w), list(w)
    if kind == "replaced":
        for i in r.sample(range(n), n // 5):
            w[i] = fresh()
    elif kind == "left out":
        for i in sorted(r.sample(range(n), n // 5), reverse=True):
            del w[i]
    elif kind == "cut":
        w = w[n // 5 :]
    elif kind == "put in":
        for i in sorted(r.sample(range(1, n), n // 2), reverse=True):
            w.insert(i, fresh())
    elif kind == "mixed":
        for i in r.sample(range(n), n // 10):
            w[i] = fresh()
        for i in sorted(r.sample(range(1, n), n // 5), reverse=True):
            w.insert(i, fresh())
    return w


def test_recall_by_kind_of_edit_and_brute_force(spark):
    r = random.Random(3)
    vocab = [f"w{k}" for k in range(400)]
    word = lambda: vocab[int(len(vocab) * r.random() ** 2)]  # noqa: E731  frequent and rare words
    text = lambda n: [word() for _ in range(n)]
    items = [text(r.randrange(6, 50)) for _ in range(25)] + [["w1", "w2"], ["w0"], ["w0", "w1", "w0", "w2"]]
    texts, planted = [], {}
    for kind in ("whole", "replaced", "left out", "cut", "put in", "mixed"):
        for i in range(25):
            planted[len(texts), i] = kind
            texts.append(" ".join(text(30) + edited(r, items[i], kind, word) + text(20)))
    for i in range(25):  # half an item, its words in another order, and only its frequent words
        texts.append(" ".join(text(10) + items[i][: len(items[i]) // 2] + text(40)))
        texts.append(" ".join(sorted(items[i]) + text(5)))
    texts += ["w1 w2", "so\nW1, w2.\nthen", "w3 w1 w2", "w0\n", "w0 w1\nw0 w2", "w0 w1 w0 w2 w1", "", None]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(docs(spark, texts), bench).collect()}
    want = brute_force(texts, [" ".join(w) for w in items])
    assert got == want
    for kind in set(planted.values()):
        mine = [k for k, v in planted.items() if v == kind]
        assert sum(k in got for k in mine) >= 0.9 * len(mine), kind
    assert {k for k in got if k[0] < 150} <= set(planted)
    n = len(texts)
    assert {(n - 8, 25), (n - 7, 25), (n - 5, 26), (n - 4, 27)} <= got and not {(n - 6, 25), (n - 3, 27)} & got


def test_common_words_in_order_are_no_copy_and_insertions_are(spark):
    r = random.Random(5)
    filler = [" ".join(r.choice(["what", "is", "the", "name", "of", "in", "year", "it", "dog", "was", "great"]) for _ in range(60)) for _ in range(20)]
    thirty = [f"t{k}" for k in range(30)]
    spread = " ".join(x + (" extra" if k % 2 else "") for k, x in enumerate(thirty[:-1])) + " t29"
    items = ["what is the name of", "in the year of the", " ".join(thirty)]
    texts = ["he asked what the name of the dog is", "what is the name", "it was in year of the great fire", "Title\nWhat is the name of?\nrest", spread, *filler]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontam.contaminated(docs(spark, texts), bench).collect()}
    assert got == {(3, 0), (4, 2)}
