"""URL filter: listed rules first, then association rules mined from labelled pages.

FP-growth finds combinations of URL tokens that go with a bad label. A rule is kept when
`MIN_PAGES` labelled pages support it, at any number of pages, most of them are bad, and far
more than pages are in general. To match, each rule is filed under the rarest token of its
combination, so a URL meets only the rules of its own rare tokens, and the rest of the
combination is checked there.

Tokens that stand on exactly the same labelled pages are one item: a rule has all of them
(closed sets), and copies of a long URL make one item instead of all subsets of its words.

No combination is left out. Items that are always among the `ITEMS` rarest of their page go
through FP-growth, with 2^`ITEMS` combinations of a page at most. Combinations with any other
item, a wide one, grow item by item in joins over the pages that hold them (`wide_rules`).
There a combination ends where a longer one can add nothing: below the pages or bad pages of
a rule, at confidence 1, on the same pages as a part of it, or where the good pages that hold
all that may be added are too many. What blocks a URL, and with which confidence, is as if all
combinations were listed.

Defined cases. Null URL or one without `://`: empty host and path, no tokens, so the
method allows it. Null labels count as good. No labelled pages, or none that are bad: no
mined rules. Repeated rows: judged alike. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "=bad"


class HostRule(NamedTuple):
    verdict: str
    host: str
    path: str


# The listed rules.
LISTED = [
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
]

#: A mined rule needs so many labelled pages, this confidence, and a share of bad pages that
#: lies so many standard errors above that of all pages.
MIN_PAGES, MIN_CONFIDENCE, DEVIATIONS = 20, 0.6, 4.0
#: Items of a page that FP-growth makes combinations of.
ITEMS = 10
#: Marks of wide and other items, which sort the wide ones first.
WIDE, OTHER = "0", "1"


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """`host` (A-Z lower-cased) and `path` of `url`; both empty without `://`."""
    after = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    parted = pages.withColumn("after", F.coalesce(after, F.lit("")))
    parted = parted.withColumn("authority", F.regexp_extract("after", "^[^/?#]*", 0))
    rest = F.expr("substring(after, length(authority) + 1)")
    return parted.select(
        *[c for c in pages.columns if c not in ("host", "path")],
        F.translate("authority", UPPER, LOWER).alias("host"),
        F.regexp_extract(rest, "^[^?#]*", 0).alias("path"),
    )


def listed_rule(rules: Sequence[HostRule]) -> Column:
    """The longest rule that fits `host` and `path`, as a struct; null when none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith(
            "path", F.lit(r.path)
        )
        own = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, own).otherwise(found)
    return found


def url_tokens() -> Column:
    """Distinct words of host, path and query of `url`, marked by where they stand; a
    number counts as one word, whatever its value."""
    after = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    rest = F.substr(after, F.length(host) + 1)
    path = F.regexp_extract(rest, "^[^?#]*", 0)
    query = F.substr(rest, F.length(path) + 1)
    words = lambda part, mark: F.transform(
        F.filter(F.split(F.lower(part), "[^\\p{L}\\p{N}]+"), lambda w: w != ""),
        lambda w: F.concat(F.lit(mark), F.when(w.rlike("^[0-9]+$"), F.lit("0")).otherwise(w)),
    )
    return F.array_distinct(F.concat(words(host, "host:"), words(path, "path:"), words(query, "query:")))


def _items(baskets: DataFrame, min_pages: int) -> DataFrame:
    """Tokens of at least `min_pages` pages by item: `item` names all tokens that stand on the
    same pages, `members` has them, `pages` is their number."""
    # sums of two hashes of the pages tell sets of pages apart
    marks = [F.xxhash64("page_id", "url", F.lit(n)).cast("decimal(20,0)").alias(f"mark{n}") for n in (1, 2)]
    tokens = baskets.select(F.explode("tokens").alias("token"), *marks)
    counted = tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("mark1").alias("mark1"), F.sum("mark2").alias("mark2")
    )
    # a set holds the words of one URL at most
    sets = counted.where(F.col("pages") >= min_pages).groupBy("pages", "mark1", "mark2")
    sets = sets.agg(F.min("token").alias("item"), F.array_sort(F.collect_list("token")).alias("members"))
    return sets.select("item", "members", "pages")


def _certain(pages: Column, rate: float) -> Column:
    """Whether `confidence` on so many pages lies far enough above the share of bad pages."""
    return F.col("confidence") >= rate + DEVIATIONS * F.sqrt(F.lit(rate * (1 - rate)) / pages)


def _generators(sets: DataFrame, shorter: DataFrame) -> DataFrame:
    """The `sets` that stand on fewer pages than any part in `shorter`, with one item less."""
    parts = F.transform(
        F.sequence(F.lit(1), F.size("items")), lambda p: F.filter("items", lambda _, at: at != p - 1)
    )
    above = shorter.select(F.col("items").alias("part"), F.col("pages").alias("above"))
    held = sets.withColumn("part", F.explode(parts)).join(above, "part").groupBy("items", "pages", "bad_pages")
    return held.agg(F.min("above").alias("above")).where("pages < above").drop("above")


def wide_rules(
    own: DataFrame, wide: DataFrame, rate: float, scratch: Scratch, min_pages: int, min_confidence: float
) -> DataFrame:
    """`antecedent` and `confidence` of rules with an item of `wide`, of any length.

    `own` has a row per page (`row`, `bad`) and `item`. A combination of k items is made where
    two of k - 1 that differ in their last item meet on a page; the first item is a wide one.
    """
    mark = F.when(F.col("wide"), F.lit(WIDE)).otherwise(F.lit(OTHER))
    named = own.join(wide.withColumn("wide", F.lit(True)), "item", "left")
    on_pages = named.select(
        "row", "bad", F.array().cast("array<string>").alias("prefix"), F.concat(mark, "item").alias("last")
    )
    rules, shorter, length = [], None, 1
    # the fewest bad pages that a rule can have
    least = min_pages * min_confidence * (1 - 1e-9)
    while True:
        counts = on_pages.groupBy("prefix", "last").agg(
            F.count(F.lit(1)).alias("pages"), F.count_if("bad").alias("bad_pages")
        )
        sets = counts.where((F.col("pages") >= min_pages) & (F.col("bad_pages") >= least))
        sets = sets.select(F.concat("prefix", F.array("last")).alias("items"), "pages", "bad_pages")
        sets = scratch.store(sets if shorter is None else _generators(sets, shorter), f"sets{length}")
        own_rules = sets.where(F.col("items")[0].startswith(WIDE)).select(
            F.transform("items", lambda i: F.substr(i, F.lit(2))).alias("antecedent"),
            (F.col("bad_pages") / F.col("pages")).alias("confidence"),
            "pages",
        )
        own_rules = own_rules.where((F.col("confidence") >= min_confidence) & _certain(F.col("pages"), rate))
        rules.append(own_rules.drop("pages"))
        # no longer combination is surer than one that is always bad
        shorter = sets.where("bad_pages < pages")
        if shorter.isEmpty():
            return reduce(DataFrame.unionByName, rules)
        grown = shorter.select(
            F.slice("items", 1, length - 1).alias("prefix"), F.col("items")[length - 1].alias("last"), "bad_pages"
        )
        if length == 1:
            level = on_pages.join(grown.drop("bad_pages"), ["prefix", "last"])
            begun = level.where(F.col("last").startswith(WIDE)).select("row").distinct()
            level = hopeful = scratch.store(level.join(begun, "row", "left_semi"), "level1")
        else:
            # items that may be added, and those of them that a page holds
            after = F.row_number().over(Window.partitionBy("prefix").orderBy(F.desc("last")))
            held = F.row_number().over(Window.partitionBy("row", "prefix").orderBy(F.desc("last")))
            level = on_pages.join(grown.withColumn("after", after), ["prefix", "last"]).withColumn("held", held)
            level = scratch.store(level, f"level{length}")
            scratch.drop(f"level{length - 1}")
            # good pages that hold all of these stay, whatever is added
            good = F.count_if(~F.col("bad") & (F.col("held") == F.col("after")))
            bounds = level.groupBy("prefix", "last").agg(F.first("bad_pages").alias("most"), good.alias("good"))
            low = bounds.where(F.col("most") < min_confidence * (1 - 1e-9) * (F.col("most") + F.col("good")))
            hopeful = level.join(low.select("prefix", "last"), ["prefix", "last"], "left_anti")
        later = level.select("row", "prefix", F.col("last").alias("next"))
        pairs = hopeful.select("row", "bad", "prefix", "last").join(later, ["row", "prefix"])
        pairs = pairs.where(F.col("last") < F.col("next"))
        begins = F.concat("prefix", F.array("last"))
        on_pages = pairs.where(begins[0].startswith(WIDE)).select(
            "row", "bad", begins.alias("prefix"), F.col("next").alias("last")
        )
        length += 1


def mine(
    pages: DataFrame,
    labels: DataFrame,
    scratch: Scratch,
    min_pages: int = MIN_PAGES,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """Rules `antecedent` -> bad with `confidence`, each with its rarest token as `anchor`.

    `labels` has `page_id` and `bad`. A page with several labels is bad if one says so.
    """
    bad = labels.groupBy("page_id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    baskets = pages.join(bad, "page_id").select("page_id", "url", url_tokens().alias("tokens"), "bad")
    # rows are numbered once and written, since pages may be repeated
    baskets = scratch.store(baskets.withColumn("row", F.monotonically_increasing_id()), "baskets")
    n, n_bad = baskets.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    items = scratch.store(_items(baskets, min_pages), "items")
    rate = n_bad / n if n else 0.0
    own = baskets.select("row", "bad", F.explode("tokens").alias("item"))
    own = scratch.store(own.join(items.select("item", "pages"), "item"), "own")
    rare = own.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pages", "item"))).alias("rare"))
    wide = rare.select(F.explode(F.slice("rare", ITEMS + 1, F.size("rare"))).alias("of")).select("of.item").distinct()
    wide = scratch.store(wide, "wide")
    chosen = own.join(wide, "item", "left_anti").groupBy("row", "bad").agg(F.collect_list("item").alias("chosen"))
    marked = F.when(F.col("bad"), F.concat("chosen", F.array(F.lit(BAD)))).otherwise(F.col("chosen"))
    mined = scratch.store(chosen.select(marked.alias("items")), "mined")
    # pages without an item are counted too
    held = mined.count()
    support = min(1.0, (min_pages - 0.5) / held) if held else 1.0
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(mined)
    with_it = F.round(F.col("support") * held / F.col("confidence"))  # pages of the combination
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
    rules = rules.where(_certain(with_it, rate) & (with_it >= min_pages)).select("antecedent", "confidence")
    if not wide.isEmpty():
        rules = rules.unionByName(wide_rules(own, wide, rate, scratch, min_pages, min_confidence))
    found = rules.withColumn("item", F.explode("antecedent")).join(items, "item").groupBy("antecedent")
    whole = found.agg(
        F.first("confidence").alias("confidence"),
        F.flatten(F.collect_list("members")).alias("tokens"),
        F.min_by("item", F.struct("pages", "item")).alias("anchor"),
    )
    return scratch.store(whole.select(F.col("tokens").alias("antecedent"), "confidence", "anchor"), "rules")


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct `url` that a mined rule matches, with the highest `confidence`."""
    tokens = urls.select("url").where("url IS NOT NULL").distinct().withColumn("tokens", url_tokens())
    candidates = tokens.select("url", "tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
    holds = F.size(F.array_except("antecedent", "tokens")) == 0
    return candidates.where(holds).groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, rules: DataFrame, listed: Sequence[HostRule] = LISTED) -> DataFrame:
    """`page_id`, `host`, `path`, `rule` (null if the method decides), `verdict`, `confidence`."""
    blocked = blocked_urls(pages, rules)
    judged = with_host_and_path(pages.select("page_id", "url")).withColumn("listed", listed_rule(listed))
    judged = judged.join(blocked, "url", "left")
    method = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("listed.rule").alias("rule"),
        F.coalesce(F.col("listed.verdict"), method).alias("verdict"),
        "confidence",
    )
