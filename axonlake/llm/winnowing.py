"""Document fingerprints by winnowing, in built-in functions only.

A text's words give hashes of all runs of K words; of every W consecutive ones the least is chosen, the rightmost of
equal ones, and kept with its place. So two texts that share W + K - 1 words in a row share a fingerprint, wherever the
passage stands, and no more than about 2 in W + 1 hashes are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved_alone

K, W = 5, 16
#: Words: runs of at most 64 characters of scripts that space their words, else single characters; A-Z count as a-z.
WORD = r"[!-\x{2E7F}]{1,64}+|[^\t-\r ]"
SPACE = r"[\t-\r ]"
#: Texts of more bytes are taken in pieces of so many words, each with the words that its last window needs.
LONG, PIECE = 1 << 20, 1 << 16
PIECES = rf"(?=({SPACE}*+(?:(?:{WORD}){SPACE}*+){{1,{PIECE + W + K - 2}}}+)){SPACE}*+(?:(?:{WORD}){SPACE}*+){{1,{PIECE}}}+"
#: Places within a piece take 20 bits, hashes 31; polynomial hashes are taken modulo a Mersenne prime.
PLACES, PRIME, BASE = 1 << 20, (1 << 31) - 1, 1_000_003
ENTRY = "array<struct<place:int,hash:bigint>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pairs(a: Column, shift: int, f: Callable[[Column, Column], Column]) -> Column:
    """f of each element and the one that stands shift places after it."""
    n = F.greatest(F.size(a) - shift, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(shift + 1), n), f)


def _grams(words: Column) -> Column:
    """Rabin-Karp hashes of K words at each place: the array, multiplied and shifted onto itself, gives runs of two, four
    and five words, so that overlapping runs share their work."""
    join = lambda size: lambda a, b: (a * pow(BASE, size, PRIME) + b) % PRIME
    one = F.transform(words, lambda w: F.xxhash64(F.lower(w)).bitwiseAND(F.lit((1 << 30) - 1)))
    two = lambda h: _pairs(h, 1, join(1))
    four = lambda h: _pairs(h, 2, join(2))
    return let(one, lambda h: let(let(two(h), four), lambda q: F.zip_with(F.slice(q, F.lit(1), F.greatest(F.size(h) - K + 1, F.lit(0))), F.slice(h, F.lit(K), F.greatest(F.size(h) - K + 1, F.lit(0))), join(1))))


def _least(v: Column) -> Column:
    """The least of every W consecutive values."""

    def of_four(shift: int) -> Callable[[Column], Column]:
        return lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - 3 * shift - 1), lambda i: F.least(*(F.get(x, i + k * shift) for k in range(4))))

    return let(let(v, of_four(1)), of_four(W // 4))


def winnowed(words: Column, from_place: Column, first: Column) -> Column:
    """Chosen runs of the words in order; places are counted from from_place. Fewer than W + K - 1 words are one window,
    fewer than K one run, unless these words only follow a piece (not first): then all their windows are in that."""
    def chosen(ws: Column) -> Column:
        packed = let(_grams(ws), lambda g: F.transform(g, lambda h, i: h * PLACES + (PLACES - 1 - i)))
        least = F.when(F.size(ws) >= W + K - 1, F.array_distinct(let(packed, _least))).when(F.size(ws) >= K, F.array(F.array_min(packed))).otherwise(F.array(F.lit(PLACES - 1).cast("long")))
        place = lambda v: (F.lit(PLACES - 1) - F.pmod(v, F.lit(PLACES))).cast("int")
        entry = lambda p: F.struct((p + from_place).cast("int").alias("place"), F.xxhash64(F.transform(F.slice(ws, p + 1, F.lit(K)), F.lower)).alias("hash"))
        return F.transform(F.transform(least, place), entry)

    return let(words, lambda ws: F.when((F.size(ws) >= W + K - 1) | (first & (F.size(ws) > 0)), chosen(ws)).otherwise(F.array().cast(ENTRY)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def fingerprint(text: Column) -> Column:
    """array<struct<place int, hash long>>: chosen runs of K words by the number of words before them, in order.

    Null and texts without a word have none; fewer than K words are one run. Capitals count as small letters, spaces
    don't count.
    """
    text = F.coalesce(text, F.lit(""))
    pieces = F.when(F.octet_length(text) > LONG, F.regexp_extract_all(text, F.lit(PIECES), F.lit(1))).otherwise(F.array(text))
    return F.array_distinct(F.flatten(F.transform(pieces, lambda p, j: winnowed(words(p), j * PIECE, j == 0))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes; two without any are alike."""
    x, y = (F.array_distinct(F.transform(f, lambda e: e["hash"])) for f in (a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y)).cast("double")), F.lit(1.0))


def respliced(text: Column, keep: Column, tail: Column) -> Column:
    """Struct (whole, part) for the fingerprint of the text's first keep code points with another tail: if whole, part is
    all of it; else it is the text's own entries before part's first place, and part.

    The last word kept may be cut or go on, the words before it stand; the last window of those is chosen alike in both
    texts, so everything from there on is computed anew and everything before is the text's own.
    """
    left = F.substring(text, F.lit(1), keep)
    spaces = " \t\n\x0b\x0c\r"

    def of(ws: Column) -> Column:
        n = F.size(ws) - 1
        restart = F.greatest(n - (W + K - 1), F.lit(0))
        cut = F.length(left) - F.length(F.rtrim(left, F.lit(spaces))) + F.coalesce(F.length(F.element_at(ws, -1)), F.lit(0))
        end = F.when(F.size(ws) > 0, F.substring(left, F.length(left) - cut + 1, cut)).otherwise(F.lit(""))
        some = F.concat(F.slice(ws, restart + 1, F.greatest(n - restart, F.lit(0))), words(F.concat(end, tail)))
        return F.struct((restart == 0).alias("whole"), winnowed(some, restart, F.lit(True)).alias("part"))

    short = let(words(left), of)
    return F.when(F.octet_length(text) > LONG, F.struct(F.lit(True).alias("whole"), fingerprint(F.concat(left, tail)).alias("part"))).otherwise(short)


def spliced(own: Column, splice: Column) -> Column:
    """The fingerprint that respliced() describes, from the text's own."""
    before = F.filter(own, lambda e: e["place"] < splice["part"][0]["place"])
    return F.when(splice["whole"], splice["part"]).otherwise(F.concat(before, splice["part"]))


def _ordered(docs: DataFrame) -> tuple[DataFrame, int]:
    """Different (k, h) of docs with their number of rows c and code points n, and i, their place by descending doc_id
    (null last), ties by h; and how many there are. Places come from ranges."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("k"), F.asc("h")]
    x = docs.groupBy("k", "h", F.length("text").cast("long").alias("n")).agg(F.count("*").alias("c"))
    x = saved_alone(x.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "order")
    part = F.shiftrightunsigned("at", 33)
    sizes = x.groupBy(part.alias("part")).agg(F.count("*").alias("m")).collect()  # one number a range
    starts, total = [], 0
    for p, m in sorted(map(tuple, sizes)):
        starts += [F.lit(p), F.lit(total)]
        total += m
    start = F.element_at(F.create_map(*starts), part) if starts else F.lit(0).cast("long")
    return x.select("k", "h", "n", "c", (start + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("i")), total


def against_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint and that of its edited text, whose last third is the first words of the next document.

    docs: doc_id, text and other columns, which are ignored. The next document is the next one by descending doc_id,
    after the last the first. Null texts are empty, null doc_ids come last; rows that share a doc_id go by the text's
    md5, and rows that are equal in both are one document whose result stands once for each. Returns doc_id, n_chars,
    edited_sha256, fingerprint and edited_fingerprint (entries), near_edited, near_next.

    Texts are dealt out once, by doc_id and md5; to each goes the head of its next one. Fingerprints are saved without
    the texts, places and hashes apart, as arrays of numbers take a third of the room of arrays of structs; then only the
    hashes go to the document before.
    """
    k, h = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), F.md5(F.coalesce("text", F.lit("")))
    docs = docs.select(k.alias("k"), F.when(F.col("doc_id").isNull(), F.concat(F.lit("-"), h)).otherwise(h).alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    order, total = _ordered(docs)
    if not total:
        total = 1
    before = order.select(F.pmod(F.col("i") + 1, F.lit(total)).alias("i"), F.col("k").alias("k_"), F.col("h").alias("h_"), F.floor(F.col("n") / 3).alias("third"))
    keys = saved_alone(order.join(before, "i"), "keys")
    texts = docs.groupBy("k", "h").agg(F.max("text").alias("text"))
    heads = texts.join(keys.select("k", "h", "k_", "h_", "third"), ["k", "h"]).select(F.col("k_").alias("k"), F.col("h_").alias("h"), F.substring("text", F.lit(1), F.col("third").cast("int")).alias("head"))
    x = texts.join(keys.select("k", "h", "i", "n", "c"), ["k", "h"]).join(heads, ["k", "h"])
    keep = (F.col("n") - F.floor(F.col("n") / 3)).cast("int")
    prints = x.select("k", "h", "i", "n", "c", F.sha2(F.concat(F.substring("text", F.lit(1), keep), "head"), 256).alias("edited_sha256"), fingerprint(F.col("text")).alias("fingerprint"), respliced(F.col("text"), keep, F.col("head")).alias("splice"))
    apart = lambda c, name: [F.col(f"{c}.place").alias(f"{name}_places"), F.col(f"{c}.hash").alias(f"{name}_hashes")]
    prints = saved_alone(prints.select("k", "h", "i", "n", "c", "edited_sha256", *apart("fingerprint", "own"), F.col("splice.whole").alias("whole"), *apart("splice.part", "part")), "fingerprints")
    after = prints.select(F.pmod(F.col("i") - 1, F.lit(total)).alias("i"), F.col("own_hashes").alias("next"))
    together = lambda name: F.zip_with(f"{name}_places", f"{name}_hashes", lambda p, h: F.struct(p.alias("place"), h.alias("hash")))
    x = prints.join(after, "i").withColumn("fingerprint", together("own")).withColumn("splice", F.struct("whole", together("part").alias("part")))
    x = x.withColumn("edited_fingerprint", spliced(F.col("fingerprint"), F.col("splice"))).withColumn("next", F.transform("next", lambda h: F.struct(h.alias("hash"))))
    doc_id = F.when(~F.col("h").startswith("-"), F.col("k")).alias("doc_id")
    out = x.select(doc_id, F.col("n").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next")).alias("near_next"), "c")
    return out.withColumn("c", F.explode(F.sequence(F.lit(1).cast("long"), "c"))).drop("c")
