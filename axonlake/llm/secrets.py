"""Secret scan in DataFrame functions only: three fixed patterns and a battery of randomness tests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, saved

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Runs that the battery looks at.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
OPEN, MID, CLOSE = "\x01", "\x02", "\x04"
#: The encodings' characters by rank.
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"}
#: For each ASCII character its rank in an encoding, with what a run's sums take from it: rank, rank << 6, its square << 21.
CODES = {n: [(1 + (1 << 6)) * r + (r * r << 21) for r in (max(0, a.find(chr(c))) for c in range(128))] for n, a in ALPHABETS.items()}
#: Characters of a run whose sums of ranks, squares and products have room in one number.
SHORT = 500
#: The least p-value that is told apart.
LEAST_P = 1e-12
#: Length classes; parts of an alphabet whose shares are tested; steps of a p-value's logarithm between 1e-12 and 1.
CLASSES, PARTS, STEPS = 50, 8, 120
#: Lengths of the natural runs that texts are cut into; the least is that of candidate runs.
NATURAL = (20, 24, 28, 34, 40, 48, 64, 96)
#: Names of the parts; the first four are the lower half of an alphabet.
PART, LOW = "abcdefgh", "abcd"
#: Length classes below a run's own whose natural runs it is compared with.
NEAR = 2
#: Matches whose places are added up at once.
BLOCK = 64
SPAN = "array<struct<start:int,k:int,end:int,value:string>>"


def _marked(text: Column, pattern: str, replacement: str) -> Column:
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit(replacement)), OPEN, -1)


def _let(x: Column, f) -> Column:
    """f of x, which is computed once however often f names it."""
    return F.transform(F.array(x), f)[0]


def _spans(text: Column, pattern: str, kind: str, ok=None) -> Column:
    """Array of (start, kind, end, value) of the pattern's leftmost non-overlapping matches, in code points. Matches are
    marked in the text by characters that occur in no pattern, and the lengths of the pieces between the marks give the
    places: they are added up by blocks, then in each block, so that a text of many matches stays cheap."""
    k = KINDS.index(kind)
    none = F.array().cast(SPAN)
    return _let(_marked(text, pattern, OPEN + "$0" + CLOSE), lambda p: F.when(F.size(p) > 1, _placed(p, k, ok)).otherwise(none))


def _placed(pieces: Column, k: int, ok) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 2) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 2, F.lit(BLOCK)))
    length = lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + F.length(x) - 1)
    first = F.struct(F.length(pieces[0]).alias("at"), F.array().cast("array<struct<at:int,block:array<string>>>").alias("out"))
    placed = F.aggregate(blocks, first, lambda a, b: F.struct((a["at"] + length(b)).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("at"), b.alias("block")))).alias("out")))["out"]

    def step(acc, piece):
        value = F.substring_index(piece, CLOSE, 1)
        hit = F.struct(acc["at"].alias("start"), F.lit(k).alias("k"), (acc["at"] + F.length(value)).alias("end"), value.alias("value"))
        keep = F.lit(True) if ok is None else ok(value)
        return F.struct((acc["at"] + F.length(piece) - 1).alias("at"), F.when(keep, F.concat(acc["found"], F.array(hit))).otherwise(acc["found"]).alias("found"))

    return F.flatten(F.transform(placed, lambda p: F.aggregate(p["block"], F.struct(p["at"].alias("at"), F.array().cast(SPAN).alias("found")), step)["found"]))


def _text() -> Column:
    """The text, null as empty, with the three mark characters replaced one by one: no pattern holds any of them."""
    return F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), OPEN + MID + CLOSE, "\x03\x03\x03")


def base_spans() -> Column:
    """Spans of the three fixed patterns, kind by kind."""
    long_enough = lambda v: F.length(F.regexp_extract(v, ASSIGN, 2)) >= 6
    return _let(_text(), lambda t: F.concat(_spans(t, ASSIGN, "assign", long_enough), _spans(t, ACCESS, "access"), _spans(t, HEX, "hex")))


def _normal_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal Z, by the logistic approximation of the normal distribution (error under 2e-4)."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z))


def _with(runs: Column | DataFrame, keep: tuple[str, ...], **fields):
    """The array of structs (or the table of rows) with the fields in keep and more, each a function of the struct (row)."""
    if isinstance(runs, DataFrame):
        return runs.select(*keep, *(f(runs).alias(n) for n, f in fields.items()))
    return F.transform(runs, lambda r: F.struct(*(r[n].alias(n) for n in keep), *(f(r).alias(n) for n, f in fields.items())))


def _sum(numbers: Column, f=lambda x: x) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda s, x: s + f(x)).cast("double")


def _pick(r: Column, values: dict) -> Column:
    """The value for the encoding of a run."""
    return F.when(r["encoding"] == "hex", F.lit(values["hex"])).when(r["encoding"] == "base32", F.lit(values["base32"])).otherwise(F.lit(values["base64"]))


def encoded(runs: Column) -> Column:
    """Candidate runs that have an encoding, with v, their characters without padding and joiners: 16 or more hex digits in
    one case; capitals and 2-7; or capitals, small letters and digits (base64)."""

    def encoding(r):
        has = lambda p: r["v"].rlike(p)
        x = F.when(F.length(r["v"]) < 16, F.lit(None).cast("string")).when(has("^([0-9a-f]+|[0-9A-F]+)$") & has("[0-9]") & has("[A-Fa-f]"), F.lit("hex"))
        return x.when(has("^[A-Z2-7]+$") & has("[2-7]") & has("[A-Z]"), F.lit("base32")).when(has("[0-9]") & has("[A-Z]") & has("[a-z]"), F.lit("base64"))

    x = _with(runs, ("start", "k", "end"), v=lambda r: F.regexp_replace(r["value"], "[=_/+-]", ""))
    return F.filter(_with(x, ("start", "k", "end", "v"), encoding=encoding), lambda r: r["encoding"].isNotNull())


def natural(docs: DataFrame) -> DataFrame:
    """What the texts' own words look like in each encoding, as runs (v, encoding): all words of all texts, capitalised
    (base64), in capitals (base32) or small (hex), their letters and digits that the encoding has, one after the other,
    cut into runs of the NATURAL lengths in turn; a hash of the text chooses the length that comes first. A text's last
    run may be shorter, if a candidate can be as short. Candidate runs are left out."""
    x = docs.select(_text().alias("t")).select(F.regexp_replace("t", F.lit(CANDIDATE), F.lit(" ")).alias("w"), F.pmod(F.xxhash64("t"), F.lit(len(NATURAL))).cast("int").alias("turn"))
    forms = (("base64", F.initcap("w"), "[A-Za-z0-9]+"), ("base32", F.upper("w"), "[A-Z2-7]+"), ("hex", F.lower("w"), "[0-9a-f]+"))
    only = lambda w, chars: F.array_join(F.regexp_extract_all(w, F.lit(chars), F.lit(0)), "")  # noqa: E731  what to leave out, as a pattern, is far slower
    pieces = lambda s: F.regexp_extract_all(s, F.lit(f".{{1,{sum(NATURAL)}}}"), F.lit(0))
    x = x.select("turn", F.explode(F.array(*(F.struct(F.lit(name).alias("encoding"), pieces(only(w, chars)).alias("pieces")) for name, w, chars in forms))).alias("r"))
    x = x.select("turn", F.col("r.encoding").alias("encoding"), F.col("r.pieces").alias("pieces")).select("turn", "encoding", F.explode("pieces").alias("s"))
    turns = [NATURAL[k:] + NATURAL[:k] for k in range(len(NATURAL))]
    places = F.array(*(F.array(*(F.struct(F.lit(1 + sum(t[:k])).alias("at"), F.lit(n).alias("n")) for k, n in enumerate(t))) for t in turns))
    x = x.select("encoding", F.explode(F.transform(places[F.col("turn")], lambda c: F.substring(F.col("s"), c["at"], c["n"]))).alias("v"))
    return x.where(F.length("v") >= NATURAL[0])


def _in_letters(r, letters: dict[str, str]) -> Column:
    """A run's characters, each replaced by the letter at its rank."""
    to = {n: F.translate(r["cased"], ALPHABETS[n], letters[n]) for n in ALPHABETS}
    return F.when(r["encoding"] == "hex", to["hex"]).when(r["encoding"] == "base32", to["base32"]).otherwise(to["base64"])


def _with_codes(r) -> Column:
    """The ranks of a run's characters as an array."""
    return _let(_pick(r, CODES), lambda codes: F.transform(F.split(r["cased"], ""), lambda c: codes[F.ascii(c)]))


def battery(runs: Column | DataFrame, keep: tuple[str, ...] = ()):
    """Runs (v, encoding), an array of structs or a table, as (encoding, length_class, bin) with the fields in keep. bin is
    the place of the p-value on a grid of STEPS logarithmic steps. The tested hypothesis is independent uniform characters:
    chi-squared uniformity over PARTS parts of the alphabet (Wilson-Hilferty), the number of runs above and below the
    alphabet's middle, lag-1 serial correlation of the characters' ranks (both normal, two-sided), combined by Bonferroni.
    Everything is a function of one array column or row, so nothing is shuffled."""
    size = {n: len(a) for n, a in ALPHABETS.items()}
    parts = {n: "".join(PART[r * PARTS // a] for r in range(a)) for n, a in size.items()}
    cased = lambda r: F.when(r["encoding"] == "hex", F.lower(r["v"])).otherwise(r["v"])
    x = _with(runs, (*keep, "encoding"), cased=cased)
    x = _with(
        x,
        (*keep, "encoding", "cased"),
        length_class=lambda r: F.least(F.floor(F.log2(F.length(r["cased"]).cast("double")) * 4), F.lit(CLASSES)).cast("int"),
        n=lambda r: F.length(r["cased"]).cast("double"),
        parts=lambda r: _in_letters(r, parts),
    )
    keep = (*keep, "encoding", "length_class")
    count = lambda r, p: r["n"] - F.length(F.replace(r["parts"], F.lit(p), F.lit("")))
    x = _with(x, (*keep, "cased", "n", "parts"), **{p: (lambda r, p=p: count(r, p)) for p in PART})
    low = lambda r, at: F.when(F.substring(r["parts"], at, 1) <= LOW[-1], 1).otherwise(0)
    share = lambda r, p: _pick(r, {n: parts[n].count(p) / a for n, a in size.items()})
    x = _with(
        x,
        (*keep, "cased", "n"),
        chi=lambda r: sum((r[p] * r[p] / share(r, p) for p in PART), F.lit(0.0)) / r["n"] - r["n"],
        high=lambda r: sum(r[p] for p in PART if p not in LOW),
        changes=lambda r: (2 * F.regexp_count(r["parts"], F.lit(f"[{LOW[0]}-{LOW[-1]}]+")) - low(r, 1) - low(r, -1)).cast("double"),
    )
    x = _with(x, (*keep, "cased", "n", "chi", "changes"), expected=lambda r: 2 * r["high"] * (r["n"] - r["high"]) / r["n"] + 1)
    df = PARTS - 1
    z_chi = lambda r: (F.pow(F.greatest(r["chi"], F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / (2 / (9 * df)) ** 0.5
    z_runs = lambda r: (r["changes"] + 1 - r["expected"]) / F.sqrt(F.greatest((r["expected"] - 1) * (r["expected"] - 2) / (r["n"] - 1), F.lit(1e-6)))
    both = lambda z: F.least(F.lit(1.0), 2 * _normal_tail(F.abs(z)))
    x = _with(x, (*keep, "cased", "n"), p=lambda r: F.least(F.lit(1.0), 3 * F.least(_normal_tail(z_chi(r)), both(z_runs(r)))))
    # Where these two tests have reached the grid's end the third can't change the bin and is left out.
    x = _with(x, (*keep, "cased", "n", "p"), codes=lambda r: F.when(r["p"] > LEAST_P, _with_codes(r)))
    # The last rank, the sums of ranks and of their squares, and that of neighbours' products, in one number of 6, 15, 21 and 21 bits.
    rank = lambda c: c.bitwiseAND(63)
    folded = lambda s, c: s + c + rank(s) * (F.shiftleft(rank(c), 42) - 1)
    x = _with(x, (*keep, "cased", "n", "p", "codes"), sums=lambda r: F.when(r["n"] <= SHORT, F.aggregate(r["codes"], F.lit(0).cast("long"), folded)))
    part_of = lambda r, at, bits, long: F.when(r["sums"].isNotNull(), F.shiftright(r["sums"], at).bitwiseAND((1 << bits) - 1).cast("double")).otherwise(long)
    from_to = lambda r, a, b: F.slice(r["codes"], a, F.size(r["codes"]) + b)
    x = _with(
        x,
        (*keep, "n", "p"),
        total=lambda r: part_of(r, 6, 15, _sum(r["codes"], rank)),
        squares=lambda r: part_of(r, 21, 21, _sum(r["codes"], lambda c: rank(c) * rank(c))),
        products=lambda r: part_of(r, 42, 21, _sum(F.zip_with(from_to(r, 1, -1), from_to(r, 2, -1), lambda p, q: rank(p) * rank(q)))),
        ends=lambda r: (rank(r["codes"][0]) + rank(F.element_at(r["codes"], -1))).cast("double"),
    )
    x = _with(
        x,
        (*keep, "n", "p"),
        var=lambda r: r["squares"] - r["total"] * r["total"] / r["n"],
        cov=lambda r: r["products"] - r["total"] / r["n"] * (2 * r["total"] - r["ends"] - r["total"] / r["n"] * (r["n"] - 1)),
    )
    z_serial = lambda r: (r["cov"] / F.greatest(r["var"], F.lit(1e-9)) + 1 / r["n"]) * F.sqrt(r["n"])
    p = lambda r: F.when(r["var"].isNull(), r["p"]).otherwise(F.least(r["p"], 3 * both(z_serial(r))))
    return _with(x, keep, bin=lambda r: F.floor((F.log10(F.greatest(p(r), F.lit(LEAST_P))) / 12 + 1) * STEPS).cast("int"))


def thresholds(tested: DataFrame, nulls: DataFrame, q: float = 0.05) -> DataFrame:
    """(encoding, length_class, cut): the least bin from which on runs are taken for secrets.

    The null hypothesis is natural text: the chance that a natural run reaches a bin comes from nulls of the encoding that
    are as long or up to NEAR classes shorter (shorter natural runs look more random, so this errs on the safe side). Benjamini and Hochberg's rule at
    level q then bounds the share of natural runs among those taken, within each class of like lengths. Both tables are
    counted by bin before the shuffle; at most encodings x CLASSES x STEPS rows go on.
    """
    by, longest = ("encoding", "length_class", "bin"), int(math.log2(NATURAL[-1]) * 4)
    of = Window.partitionBy("encoding", "length_class")
    here = tested.groupBy(*by).agg(F.count("*").alias("n"))
    here = here.select(*by, F.sum("n").over(of.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)).alias("reached"), F.sum("n").over(of).alias("m"))
    null = nulls.groupBy(*by).agg(F.count("*").alias("n")).select(F.col("encoding").alias("e"), F.col("length_class").alias("c"), F.col("bin").alias("b"), "n")
    x = here.join(null, (F.col("encoding") == F.col("e")) & (F.col("c") <= F.col("length_class")) & (F.col("c") >= F.least(F.col("length_class"), F.lit(longest)) - NEAR), "left")
    chance = (1 + F.sum(F.when(F.col("b") >= F.col("bin"), F.col("n")).otherwise(0))) / (1 + F.coalesce(F.sum("n"), F.lit(0)))
    x = x.groupBy(*by, "reached", "m").agg(chance.alias("p"))
    return x.where(F.col("m") * F.col("p") <= q * F.col("reached")).groupBy("encoding", "length_class").agg(F.min("bin").alias("cut"))


def scan(docs: DataFrame, q: float = 0.05, keep: list[str] | None = None, column: str = "spans") -> DataFrame:
    """docs (every column, or those in keep) plus column: array of (start, k, end) by start, then kind; k indexes KINDS.

    Kinds assign, access and hex are the fixed patterns. Kind random are runs of 20 characters and more, outside the base
    spans, that have an encoding and look more random than natural text does: at most a share q of those found is expected
    to be natural, among runs of like length over the whole table. The battery is evaluated once for each run; its results
    are saved with the kept columns. The natural runs to compare with are all words of all texts, which are read once more
    for them and counted by bin; a table without natural text has no kind random.

    Null text has no spans; rows, repeated ones too, keep their number; an empty table stays empty; other columns pass
    through (one named like column is replaced). At most encodings x CLASSES thresholds come to the driver.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() != column.lower()]
    base, runs = fresh(docs, "_base", "_runs")
    slim = lambda a: F.transform(a, lambda r: F.struct(r["start"].alias("start"), r["k"].alias("k"), r["end"].alias("end")))
    found = battery(encoded(_spans(_text(), CANDIDATE, "random")), ("start", "k", "end"))
    x = saved(docs.select(*(F.col(f"`{c}`") for c in names), slim(base_spans()).alias(base), found.alias(runs)), "tested")
    nulls = battery(natural(x if "text" in names else docs))
    cuts = thresholds(x.select(F.explode(runs).alias("r")).select("r.*"), nulls, q).collect()
    of = F.create_map(*(F.lit(y) for r in cuts for y in (f"{r['encoding']}{r['length_class']}", r["cut"]))) if cuts else None
    cut = lambda r: F.coalesce(F.element_at(of, F.concat(r["encoding"], r["length_class"].cast("string"))), F.lit(STEPS + 1)) if cuts else F.lit(STEPS + 1)
    clear = lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))
    extra = F.filter(runs, lambda r: (r["bin"] >= cut(r)) & clear(r))
    return x.select(*(F.col(f"`{c}`") for c in names), F.array_sort(F.concat(base, slim(extra))).alias(column))


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda r: F.concat_ws(":", F.element_at(kinds, r["k"] + 1), r["start"].cast("string"), r["end"].cast("string"))), ",")


def redacted(docs: DataFrame, q: float = 0.05, mask: str = "[SECRET]") -> DataFrame:
    """docs with each secret in text replaced by mask, and every other column as it was. Overlapping spans are replaced
    together. Documents without a secret keep their text, null included."""
    names, (spans,) = docs.columns, fresh(docs, "_spans")
    x = scan(docs, q, column=spans)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda acc, r: F.struct(F.greatest(acc["at"], r["end"]).alias("at"), F.when(r["start"] >= acc["at"], F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, r["start"] - acc["at"]), F.lit(mask)))).otherwise(acc["out"]).alias("out"))
    cut = F.aggregate(spans, start, step)
    clean = F.transform(F.array(cut), lambda c: F.concat(F.array_join(c["out"], ""), F.substring(F.col("text"), c["at"] + 1, F.length("text"))))[0]
    return x.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(F.col("text"))).select(*(F.col(f"`{c}`") for c in names))
