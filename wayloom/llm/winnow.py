"""Document fingerprints by winnowing, with DataFrame functions only.

Every k code points of a text are hashed; of each window of w consecutive hashes
the least is chosen, the rightmost of equal ones. A chosen gram is one number: the
top 33 bits of its hash, then 2**30 - 1 minus its position, so that the least number
is the least hash and, among equals, the rightmost. Any run of w + k - 1 characters
that two texts share gives them a gram in common, and its positions in both.

The hashes come from one pass of a regular expression with a lookahead, the window
minima from log2(w) pairwise passes; both are linear in the length of the text. Very long
texts are read in pieces, as each gram is a string of its own while it is hashed.

Edge cases: null counts as the empty text, whose fingerprint is empty; a text of
fewer than k characters has one gram, itself; one of fewer than w grams has one
window. Two empty fingerprints are alike (1), an empty and another are not (0).
Rows are ordered by falling id, equal ids by a hash of the text; rows without an id
have no successor (it counts as empty) and are no one's. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, W = 8, 16
QUANTILES = 1024
PIECE = 1 << 18
_POSITIONS = (1 << 30) - 1
_ALL = 1 << 30
#: Up to so many buckets (24 bytes each) their first ids are broadcast; beyond, the join is a shuffle.
BROADCAST_BUCKETS = 1 << 18


def _pack(gram: Column, position: Column) -> Column:
    return F.shiftleft(F.shiftright(F.xxhash64(gram), 31), 30).bitwiseOR(F.lit(_POSITIONS) - position)


def _grams(text: Column, k: int) -> Column:
    """Every k code points of a text; of a shorter one that isn't empty, one empty string."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}})).|^.{{1,{k - 1}}}$"), F.lit(0 if k == 1 else 1))


def _pairwise(least: Column, reach: int) -> Column:
    """Minima over twice as many neighbours, at all places but the last ones."""
    return F.zip_with(least, F.slice(least, reach + 1, _ALL), lambda a, b: F.least(a, b))


def _in_pieces(text: Column, shift: Column, k: int, w: int, piece: int) -> Column:
    """Minima of all windows of a long text, `piece` of them at a time, so that its grams are never in memory together."""
    named = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))

    def doubled(reach: int):
        return lambda x: _pairwise(x, reach)

    def minima(p: Column) -> Column:
        own = F.substring(text, (p * piece + 1).cast("int"), F.lit(piece + k + w - 2))
        out = F.transform(_grams(own, k), lambda g, i: _pack(g, i + shift + (p * piece).cast("int")))
        reach = 1
        while reach < w:
            out = named(out, doubled(reach))
            reach *= 2
        return named(out, lambda x: F.slice(x, 1, F.size(x) - (w - 1)))

    last = F.call_function("div", F.length(text) - (k + w - 1), F.lit(piece))
    return F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")), minima))


def with_minima(df: DataFrame, text: str, out: str, offset: Column | None = None, short: Column | None = None, k: int = K, w: int = W, piece: int = PIECE) -> DataFrame:
    """df with the packed minimum of every window of the text.

    offset: position of the text's first character in a larger one. short: whether a
    text of fewer than w grams has a window at all (it has, unless stated). Texts of over
    `piece` code points, which is more than a window, are read in pieces of that many.
    """
    if w & (w - 1):
        raise ValueError("w must be a power of two")
    if piece < k + w:
        raise ValueError("a piece must hold a window")
    shift = F.lit(0) if offset is None else offset
    long, own = F.length(text) > piece, f"{out}_t"
    df = df.withColumn(own, F.when(long, F.lit("")).otherwise(F.col(text)))
    packed = F.transform(_grams(F.col(own), k), lambda g, i: _pack(g, i + shift))
    # A text shorter than k has itself as its gram.
    whole = F.when(F.col(own) == "", F.array().cast("array<bigint>")).otherwise(F.array(_pack(F.col(own), shift)))
    few = F.col(own).rlike(f"(?s)\\A.{{0,{k - 1}}}\\z")
    df = df.withColumn(out, F.when(few, whole).otherwise(packed)).withColumn(f"{out}_n", F.size(out))
    reach = 1
    while reach < w:
        df = df.withColumn(out, _pairwise(F.col(out), reach))
        reach *= 2
    least = F.lit(1) if short is None else F.when(short, 1).otherwise(0)
    minima = F.slice(out, 1, F.greatest(F.col(f"{out}_n") - (w - 1), F.least(least, F.col(f"{out}_n"))))
    return df.withColumn(out, F.when(long, _in_pieces(F.col(text), shift, k, w, piece)).otherwise(minima)).drop(f"{out}_n", own)


def chosen(minima: str) -> Column:
    """Distinct chosen grams: neighbouring windows mostly choose the same one."""
    return F.array_distinct(F.col(minima))


def fingerprint(df: DataFrame, text_col: str = "text", out: str = "grams", k: int = K, w: int = W) -> DataFrame:
    """df with the chosen grams of the text: array of packed hashes and positions."""
    df = df.withColumn("__wl_t", F.coalesce(F.col(text_col), F.lit("")))
    return with_minima(df, "__wl_t", out, k=k, w=w).withColumn(out, chosen(out)).drop("__wl_t")


def hashes(grams: str) -> Column:
    """Distinct hashes of chosen grams, without positions."""
    return F.array_distinct(F.transform(F.col(grams), lambda x: F.shiftright(x, 30)))


def positions(grams: str) -> Column:
    """Position of each chosen gram, in code points."""
    return F.transform(F.col(grams), lambda x: F.lit(_POSITIONS) - x.bitwiseAND(F.lit(_POSITIONS)))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    common = F.size(F.array_intersect(F.col(a), F.col(b)))
    total = F.size(a) + F.size(b) - common
    return F.when(total == 0, 1.0).otherwise(common / total)


def _below(buckets: DataFrame, fan: int = 4096) -> DataFrame:
    """(b, below): each non-empty bucket and the next lower one, the highest after the lowest.

    Neighbours are found inside groups of `fan` bucket numbers; only the groups'
    ends, a few for each million buckets, meet in one task.
    """
    group = F.expr(f"b div {fan}")
    inner = Window.partitionBy("g").orderBy("b")
    ends = buckets.groupBy(group.alias("g")).agg(F.max("b").alias("high"))
    highest = F.max("high").over(Window.partitionBy())
    ends = ends.select("g", F.coalesce(F.lag("high").over(Window.orderBy("g")), highest).alias("before"))
    return buckets.withColumn("g", group).withColumn("lag", F.lag("b").over(inner)).join(ends, "g").select("b", F.coalesce("lag", "before").alias("below"))


def _cells(rows: DataFrame, per_bucket: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """(first id, width, buckets, first bucket) of cells of ids that hold about as many rows each.

    Cells end at quantiles, at most QUANTILES of them, so an outlying id widens one cell
    only. An id at which several quantiles fall has a cell, and as many cells' buckets, of its own.
    """
    low, high, n = rows.agg(F.min("id"), F.max("id"), F.count("id")).first()
    if not n:
        return [0], [1], [1], [0]
    groups = max(1, min(QUANTILES, n // per_bucket))
    at = rows.agg(F.percentile_approx("id", [k / groups for k in range(1, groups)], 10_000)).first()[0] if groups > 1 else []
    times = Counter(at)
    starts = sorted({low, *times, *(x + 1 for x, m in times.items() if m > 1 and x < high)})
    widths = [b - a for a, b in zip(starts, [*starts[1:], high + 1], strict=True)]
    each = max(1, -(-n // (groups * per_bucket)))
    buckets = [min(each, w) if w > 1 else each * times[a] if times[a] > 1 else 1 for a, w in zip(starts, widths, strict=True)]
    return starts, widths, buckets, list(accumulate(buckets, initial=0))[:-1]


def with_bucket(rows: DataFrame, per_bucket: int) -> DataFrame:
    """rows (id, tie, ...) with b, a bucket of neighbouring ids that rises with the id; inside an id it falls with the tie.

    The cell is found by halving in an array of fixed size, its bucket by the share of the
    cell's width that the id has passed. Rows without an id are dealt by their tie, below 0.
    """
    starts, widths, buckets, first = _cells(rows, per_bucket)
    array = lambda v, kind="bigint": F.expr(f"array({','.join(map(str, v))})").cast(f"array<{kind}>")
    steps = [1 << k for k in reversed(range(max(1, (len(starts) - 1).bit_length())))]
    here = lambda at, step: F.when((at + step < len(starts)) & (F.get(array(starts, "decimal(20,0)"), at + step) <= F.col("id")), at + step).otherwise(at)
    cell = F.aggregate(F.array(*(F.lit(x) for x in steps)), F.lit(0), here)
    rows = rows.withColumn("cell", cell)
    of = lambda v, kind="bigint": F.get(array(v, kind), F.col("cell"))
    rows = rows.withColumns({"start": of(starts, "decimal(20,0)"), "width": of(widths, "decimal(20,0)"), "many": of(buckets), "base": of(first)})
    by_id = F.expr("cast(((cast(id as decimal(20, 0)) - start) * many) div width as bigint)")
    share = F.shiftrightunsigned(F.col("tie").bitwiseXOR(F.lit(-(1 << 63))), 33)
    by_tie = F.col("many") - 1 - F.shiftright(share * F.col("many"), 31)
    b = F.col("base") + F.when(F.col("width") > 1, by_id).otherwise(by_tie)
    none = -1 - F.pmod(F.col("tie"), F.lit(1 << 20))
    return rows.withColumn("b", F.when(F.col("id").isNull(), none).otherwise(b)).drop("cell", "start", "width", "many", "base")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 256, k: int = K, w: int = W) -> DataFrame:
    """Each text against itself with its last third replaced from the next text, and against the next text.

    The next document in falling order of the id is found inside buckets of about
    `per_bucket` neighbouring rows; each bucket also gets a copy of the first row of
    the bucket below it, so no row looks outside its bucket. Returns id, n_chars,
    edited, grams, edited_grams, near_edited, near_next.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("tie", F.xxhash64("t"))
    own = with_bucket(rows, per_bucket).withColumn("halo", F.lit(False))
    tops = own.where("id is not null").groupBy("b").agg(F.max(F.struct("id", F.bitwise_not("tie").alias("tie"))).alias("top"))
    few = -(-docs.count() // per_bucket) <= BROADCAST_BUCKETS
    edges = _below(tops.select("b")).join(tops.select(F.col("b").alias("below"), "top"), "below").select("top.id", F.bitwise_not("top.tie").alias("tie"), F.col("b").alias("to"))
    halo = rows.join(F.broadcast(edges) if few else edges, ["id", "tie"]).dropDuplicates(["id", "tie", "to"]).select("id", "t", "tie", F.col("to").alias("b"), F.lit(True).alias("halo"))
    both = own.select("id", "t", "tie", "b", "halo").unionByName(halo).withColumn("n", F.length("t"))
    order = Window.partitionBy("b").orderBy("halo", F.col("id").desc(), "tie")
    none = F.col("id").isNull()
    df = both.withColumn("after", F.when(none, F.lit("")).otherwise(F.coalesce(F.lead("t").over(order), F.lit(""))))
    third = F.expr("n div 3")
    df = df.withColumn("edited", F.concat(F.substring("t", F.lit(1), F.col("n") - third), F.substring("after", F.lit(1), third)))
    df = with_minima(df, "t", "m", k=k, w=w)
    # Windows inside the unchanged beginning are the text's own; the rest are those of the remaining string.
    df = df.withColumn("kept", F.greatest(F.lit(0), F.col("n") - third - (k + w - 2)))
    df = df.withColumn("rest", F.substring("edited", F.col("kept") + 1, F.lit(_ALL)))
    df = with_minima(df, "rest", "r", offset=F.col("kept"), short=F.col("kept") == 0, k=k, w=w)
    df = df.withColumn("grams", chosen("m")).withColumn("all", F.concat(F.slice("m", F.lit(1), F.col("kept")), "r"))
    df = df.withColumn("edited_grams", chosen("all")).drop("m", "r", "all", "rest", "kept", "after", "t")
    df = df.withColumns({"h": hashes("grams"), "he": hashes("edited_grams")})
    df = df.withColumn("near_edited", likeness("h", "he")).drop("he")
    df = df.withColumn("hn", F.when(none, F.array().cast("array<bigint>")).otherwise(F.coalesce(F.lead("h").over(order), F.array().cast("array<bigint>"))))
    df = df.where("not halo").withColumn("near_next", likeness("h", "hn"))
    return df.select(F.col("id").alias(id_col), F.col("n").cast("bigint").alias("n_chars"), "edited", "grams", "edited_grams", "near_edited", "near_next")
