"""Document fingerprints that add up: a homomorphic hash of a multiset of paragraphs.

A paragraph hashes to a wide vector: a one, two 60-bit words, and 120 lanes of one bit each.
A document's fingerprint is the sum of its paragraphs' vectors modulo 2^60, so the order of
paragraphs does not matter and a paragraph is added or taken out without the others. Lanes are counters, three to a number of 60 bits. Centred, they are a random
projection of the multiset, so the cosine of two documents' lanes estimates the cosine of
their paragraph counts. Lines are paragraphs; a line is cut after each sentence.

Defined cases. Null text: the empty text, which has no paragraph and the zero vector. Blank
space around a paragraph does not count. Repeated paragraphs count each time. Texts of more
than 2^20 paragraphs keep exact equality; their likeness is blurred. Two empty texts are
alike (1), an empty and another text are not (0). Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import text_or_empty

PARAGRAPH = r"[^.!?\n]+[.!?\n]*|[.!?\n]+"
BLANK = " \t\r\n"
LANE_BITS = 20
#: One bit in each of the three lanes of a number.
LANES = 1 | 1 << LANE_BITS | 1 << 2 * LANE_BITS
WHOLE = (1 << 60) - 1
WIDTH = 3 + 2 * LANE_BITS
#: Documents that one task orders, about; ranges of ids, at most.
ORDERED, QUANTILES, MOST_RANGES = 1_000, 64, 16_384


def paragraphs(text: Column) -> Column:
    parts = F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0))
    trimmed = F.transform(parts, lambda p: F.btrim(p, F.lit(BLANK)))
    return F.filter(trimmed, lambda p: p != "")


def _words(paragraph: Column) -> Column:
    """Two numbers of 60 bits from a paragraph's digest."""
    digest = F.md5(paragraph)
    word = lambda at: F.conv(F.substr(digest, F.lit(at), F.lit(15)), 16, 10).cast("long")
    return F.array(word(1), word(17))


def _spread(words: Column) -> Column:
    """A paragraph's vector: a one, the words, and each of their bits in a lane."""
    lanes = [
        F.shiftright(words[i], k).bitwiseAND(F.lit(LANES)) for i in range(2) for k in range(LANE_BITS)
    ]
    return F.array(F.lit(1).cast("long"), words[0], words[1], *lanes)


def zero() -> Column:
    return F.array_repeat(F.lit(0).cast("long"), WIDTH)


def combine(a: Column, b: Column) -> Column:
    """The vector of two multisets together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(WHOLE)))


def without(a: Column, b: Column) -> Column:
    """The vector of `a` after the paragraphs of `b` are taken out."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(WHOLE)))


def fingerprint(text: Column) -> Column:
    """The sum of the vectors of all paragraphs of `text`; its first number counts them."""
    words = F.transform(paragraphs(text), _words)
    return F.aggregate(words, zero(), lambda total, w: combine(total, _spread(w)))


def as_text(vector: Column) -> Column:
    """A fingerprint as a string: its numbers in hex."""
    return F.array_join(F.transform(vector, lambda x: F.lower(F.hex(x))), ".")


def centred(vector: Column) -> Column:
    """Per lane, twice its count less the number of paragraphs."""
    packed = F.slice(vector, 4, 2 * LANE_BITS)
    lane = lambda i: F.transform(
        packed, lambda x: F.shiftright(x, i * LANE_BITS).bitwiseAND(F.lit((1 << LANE_BITS) - 1)) * 2
    )
    lanes = F.concat(*[lane(i) for i in range(3)])
    return F.transform(lanes, lambda c: c - vector[0])


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0).cast("long"), lambda total, x: total + x).cast("double")


def likeness(x: Column, y: Column) -> Column:
    """Estimated cosine of two fingerprints' paragraph counts, from their centred lanes: 0 to
    1, and 1 for equal lanes."""
    size = F.sqrt(_dot(x, x) * _dot(y, y))
    cosine = F.when(size > 0, _dot(x, y) / size).otherwise(F.lit(0.0))
    return F.when(x == y, F.lit(1.0)).otherwise(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(0.0)))


def _with_range(rows: DataFrame) -> DataFrame:
    """`rows` with `range`, which grows with `order_id`, of about `ORDERED` rows each:
    quantiles of the ids, cut into equal steps."""
    n = rows.count()
    steps = max(1, min(MOST_RANGES, -(-n // ORDERED)) // QUANTILES)
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    cuts = rows.agg(F.percentile_approx("order_id", shares)).first()[0] or [0, 0]
    cuts = sorted(set(cuts))
    quantile = F.lit(0)
    for at, cut in enumerate(cuts[1:-1], start=1):
        quantile = F.when(F.col("order_id") >= cut, F.lit(at)).otherwise(quantile)
    low, high = F.array(*[F.lit(float(c)) for c in cuts[:-1] or cuts]), F.array(*[F.lit(float(c)) for c in cuts[1:] or cuts])
    rows = rows.withColumn("quantile", quantile)
    bottom, top = F.get(low, F.col("quantile")), F.get(high, F.col("quantile"))
    share = (F.col("order_id").cast("double") - bottom) / F.greatest(top - bottom, F.lit(1.0))
    step = F.greatest(F.lit(0), F.least(F.lit(steps - 1), F.floor(share * steps))).cast("int")
    return rows.withColumn("range", F.col("quantile") * steps + step).drop("quantile")


def with_next(rows: DataFrame, columns: list[str], row_id: str = "doc_id") -> DataFrame:
    """`rows` with `next_<column>`: the values of the next row in descending id, which after
    the last row is the first. Null ids come last; rows of one id are ordered by `columns`.

    Rows move once, by ranges of ids. Each range also gets the first row of the range below
    it, which follows its own last row.
    """
    ranged = _with_range(rows.withColumn("order_id", F.coalesce(F.col(row_id), F.lit(-(1 << 63)))))
    tops = ranged.groupBy("range").agg(F.max("order_id").alias("order_id"))
    # at most MOST_RANGES rows
    by_range = Window.partitionBy(F.lit(0)).orderBy("range")
    follows = tops.select(
        "range",
        "order_id",
        F.coalesce(F.lead("range").over(by_range), F.min("range").over(Window.partitionBy(F.lit(0)))).alias("also_in"),
    )
    own = ranged.join(F.broadcast(follows), ["range", "order_id"], "left")
    places = F.concat(
        F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("borrowed"))),
        F.when(
            F.col("also_in").isNotNull(),
            F.array(F.struct(F.col("also_in").alias("range"), F.lit(True).alias("borrowed"))),
        ).otherwise(F.array().cast("array<struct<range:int,borrowed:boolean>>")),
    )
    placed = own.withColumn("place", F.explode(places)).drop("range", "also_in")
    order = Window.partitionBy("place.range").orderBy(
        F.col("place.borrowed"), F.desc("order_id"), *[F.desc_nulls_last(c) for c in columns]
    )
    led = placed.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return led.where("NOT place.borrowed").drop("place", "order_id")


def edited_pairs(documents: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text and their likeness.

    The edited text ends, instead of with the last floor(n / 2) code points of the text,
    with as many from the head of the next document, or with all it has.
    """
    rows = documents.select("doc_id", text_or_empty().alias("text"))
    rows = rows.withColumn("own", fingerprint(F.col("text")))
    rows = with_next(rows, ["text", "own"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    rows = rows.withColumn("changed", fingerprint(F.col("edited")))
    for name in ("own", "next_own", "changed"):
        rows = rows.withColumn(f"{name}_lanes", centred(F.col(name)))
    near = lambda other: F.round(likeness(F.col("own_lanes"), F.col(other)), 6)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        near("changed_lanes").alias("near_edited"),
        near("next_own_lanes").alias("near_next"),
    )
