import base64
import hashlib
import math
import random
import re
import string

from pyspark.sql import functions as F

from axonlake.llm import secrets

from .helpers import corpus, docs


def slow(text):
    t, out = text or "", []
    for k, p, ok in ((0, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6), (1, r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (2, r"[0-9a-f]+", lambda m: len(m[0]) >= 24)):
        out += [(m.start(), k, m.end()) for m in re.finditer(p, t) if ok(m)]
    return sorted(out)


def test_base_spans(spark):
    texts = corpus()
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan(docs(spark)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert [s for s in got[i] if s[1] < 3] == slow(t), t
    d = secrets.scan(docs(spark)).select(F.sha2(secrets.digest(F.filter("spans", lambda r: r["k"] < 3)), 256)).first()[0]
    assert d == hashlib.sha256(",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in slow(texts[0])).encode()).hexdigest()


def prose(r, n=60):
    return " ".join("".join(r.choice(("ta", "ren", "sol", "i", "mer", "que", "la", "ston", "e", "ving")) for _ in range(r.randrange(1, 4))) for _ in range(n))


def test_battery_tells_random_from_structured(spark):
    r = random.Random(3)
    random_ones = [base64.b64encode(r.randbytes(30)).decode().rstrip("=") for _ in range(150)]
    plain = ["Aa1" + "".join(r.choice("xxyyz") for _ in range(37)) for _ in range(150)]
    words = ["internationalisation" * 2 for _ in range(50)]
    x = docs(spark, [f"{prose(r)} see {t} here" for t in random_ones + plain + words])
    got = {row.doc_id: len(row.spans) for row in secrets.scan(x).collect()}
    assert sum(got[i] for i in range(150)) >= 115
    assert sum(got[i] for i in range(150, 350)) == 0


def test_few_natural_identifiers_are_taken_for_secrets(spark):
    r = random.Random(8)
    names = "get user token index map cache value stream writer buffer parse line count total batch order model state query filter table".split()
    plain = ["".join(w.capitalize() for w in r.sample(names, 6)) + str(r.randrange(10)) for _ in range(400)]
    hidden = ["".join(r.choice(string.ascii_letters + string.digits) for _ in range(r.choice((28, 32, 40)))) for _ in range(100)]
    x = docs(spark, [f"{prose(r)} {' '.join(r.sample(names, 15))} {t} {prose(r)}" for t in plain + hidden] + [prose(r) for _ in range(1500)])
    got = {row.doc_id: len(row.spans) for row in secrets.scan(x).collect()}
    assert sum(got[i] for i in range(400)) <= 20 and sum(got[i] for i in range(400, 500)) >= 60


def slow_bin(v, encoding):
    """The battery's p-value on its grid, number by number."""
    a = secrets.ALPHABETS[encoding]
    x = [a.index(c) for c in v]
    n, size = len(x), len(a)
    part = [sum(i * 8 // size == b for i in range(size)) / size for b in range(8)]
    chi = sum(sum(i * 8 // size == b for i in x) ** 2 / part[b] for b in range(8)) / n - n
    tail = lambda z: 1 / (1 + math.exp(1.5976 * max(-8, min(8, z)) + 0.070566 * max(-8, min(8, z)) ** 3))
    both = lambda z: min(1, 2 * tail(abs(z)))
    high = [2 * i >= size for i in x]
    h, changes = sum(high), sum(p != q for p, q in zip(high, high[1:], strict=False))
    e, mean = 2 * h * (n - h) / n + 1, sum(x) / n
    runs = (changes + 1 - e) / math.sqrt(max((e - 1) * (e - 2) / (n - 1), 1e-6))
    cov, var = sum((p - mean) * (q - mean) for p, q in zip(x, x[1:], strict=False)), sum((i - mean) ** 2 for i in x)
    p = min(1, 3 * min(tail(((max(chi, 0) / 7) ** (1 / 3) - (1 - 2 / 63)) / math.sqrt(2 / 63)), both(runs), both((cov / max(var, 1e-9) + 1 / n) * math.sqrt(n))))
    return math.floor((math.log10(max(p, 1e-12)) / 12 + 1) * secrets.STEPS)


def test_battery_and_cuts_against_brute_force(spark):
    r = random.Random(5)
    runs = [("".join(r.choice(secrets.ALPHABETS[e][: r.choice((6, 99))]) for _ in range(r.randrange(16, 70))), e) for e in secrets.ALPHABETS for _ in range(80)]
    x = spark.createDataFrame([(runs,)], "runs array<struct<v:string,encoding:string>>")
    got = [(g.encoding, g.length_class, g.bin) for g in x.select(secrets.battery(F.col("runs"))).first()[0]]
    want = [(e, math.floor(math.log2(len(v)) * 4), slow_bin(v, e)) for v, e in runs]
    assert sum(abs(g[2] - w[2]) > 0 for g, w in zip(got, want, strict=True)) <= 2 and [g[:2] for g in got] == [w[:2] for w in want]
    tested = [(e, c, r.randrange(40, 121)) for e, c, _ in want]
    null = [(e, c, min(120, int(r.expovariate(1 / 25)))) for e, c, _ in want * 3]
    frame = lambda rows: spark.createDataFrame(rows, "encoding string, length_class int, bin int")
    cuts = {(c.encoding, c.length_class): c.cut for c in secrets.thresholds(frame(tested), frame(null), 0.3).collect()}
    slow = {}
    for e, c, b in sorted(tested, reverse=True):
        mine = [t[2] for t in tested if t[:2] == (e, c)]
        n = [t[2] for t in null if t[0] == e and min(c, 26) - 2 <= t[1] <= c]
        if len(mine) * (1 + sum(y >= b for y in n)) / (1 + len(n)) <= 0.3 * sum(y >= b for y in mine):
            slow[e, c] = min(b, slow.get((e, c), b))
    assert cuts == slow and slow


def test_many_matches_in_one_text(spark):
    t = " ".join(f"AKIA{'A' * (16 + i % 9)}é" for i in range(1000))
    got = [tuple(s) for s in secrets.scan(docs(spark, [t])).first().spans if s.k < 3]
    assert got == slow(t) and len(got) == 1000


def test_redaction_and_empty(spark):
    x = secrets.redacted(docs(spark, ["a password=hunter22 b", None, "clean"]))
    assert [r.text for r in x.orderBy("doc_id").collect()] == ["a [SECRET] b", None, "clean"]
    assert x.columns == docs(spark, []).columns and {r.spans for r in x.collect()} == {"clash"}
    y = secrets.redacted(docs(spark, ["a password=hunter22 b"]).selectExpr("*", "1 AS _base", "2 AS _runs", "3 AS _spans", "4 AS `a.b`"))
    assert tuple(y.first())[-4:] == (1, 2, 3, 4) and y.columns[-1] == "a.b"
    assert secrets.scan(docs(spark, [])).collect() == []


def test_natural_runs_are_all_words_of_a_text(spark):
    text = prose(random.Random(4), 900) + " Zq7xW9 zebra 2345"
    assert len(text) > 4000
    got = secrets.natural(docs(spark, [text])).collect()
    for name, form, others in (("base64", str.title, "[^A-Za-z0-9]"), ("base32", str.upper, "[^A-Z2-7]"), ("hex", str.lower, "[^0-9a-f]")):
        want, runs = re.sub(others, "", form(text)), [r.v for r in got if r.encoding == name]
        assert want.lower().startswith("".join(runs).lower()) and len(want) - sum(map(len, runs)) < 20
        assert all(len(v) in secrets.NATURAL for v in runs[:-1]) and len({len(v) for v in runs}) > 7


def test_no_piece_of_a_text_carries_the_whole_text(spark):
    """Each piece that is cut from a text goes on without it, or a long text is copied once for each of its pieces."""
    plan = secrets.natural(docs(spark, ["some words"]))._jdf.queryExecution().executedPlan().toString()
    kept = [re.sub(r"#\d+L?", "", line.split("), [")[1].split("]")[0]) for line in plan.splitlines() if "Generate explode(pieces" in line]
    assert kept == ["turn, encoding"]


def test_battery_of_runs_at_the_limit_of_packed_sums(spark):
    r = random.Random(6)
    sizes = (secrets.SHORT - 1, secrets.SHORT, secrets.SHORT + 1, 3000)
    runs = [("".join(r.choice(a) for _ in range(n)), e) for e, a in secrets.ALPHABETS.items() for n in sizes] + [("9" * n, "base64") for n in sizes]
    runs = [(v, e) for v, e in runs if len(set(v)) > 1] + [("8" + v, e) for v, e in runs if len(set(v)) == 1 and len(v) != secrets.SHORT]
    x = spark.createDataFrame([(runs,)], "runs array<struct<v:string,encoding:string>>")
    got = [g.bin for g in x.select(secrets.battery(F.col("runs"))).first()[0]]
    rows = secrets.battery(spark.createDataFrame(runs, "v string, encoding string")).groupBy("bin").count()
    assert all(abs(g - slow_bin(v, e)) <= 1 for g, (v, e) in zip(got, runs, strict=True))
    assert sorted(got) == sorted(b for b, n in rows.collect() for _ in range(n))


def test_ranks_are_read_only_where_they_can_change_the_bin(spark):
    """Ranks are for the third test; where the others alone are at the grid's end, the bin is the same without them."""
    r = random.Random(9)
    runs = [("".join(r.choice(a[: r.choice((3, 5, len(a)))]) for _ in range(r.choice((24, 64, 300)))), e) for e, a in secrets.ALPHABETS.items() for _ in range(30)]
    x = spark.createDataFrame(runs, "v string, encoding string")
    seen, real = [], secrets._with

    def spy(rows, keep, **fields):
        out = real(rows, keep, **fields)
        return seen.append(out) or out if "codes" in fields else out

    secrets._with = spy
    try:
        got = [g.bin for g in secrets.battery(x).collect()]
    finally:
        secrets._with = real
    ranks = [g.codes is not None for g in seen[0].collect()]
    assert all(abs(g - slow_bin(v, e)) <= 1 for g, (v, e) in zip(got, runs, strict=True))
    assert {g for g, read in zip(got, ranks, strict=True) if not read} == {0} and any(ranks)
