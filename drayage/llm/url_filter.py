"""URL verdicts: the longest fitting rule, else a likelihood ratio of variable-order character models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drayage.llm.common import cut

#: Symbols of the models: letters (without case), one for all digits, marks that structure a URL, one for all else; and the start.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0/:.-_?=&#%~+@!"
START = len(SYMBOLS) + 1
SIZE = START + 1
STEPS = 2**20
#: Where the numbers of contexts begin, downwards.
ONE = -1 - SIZE**2 - SIZE
TWO = ONE - SIZE

#: (verdict, host, path prefix)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _lower(c: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first :// up to / ? or #, and then up to ? or #; both empty without ://."""
    whole = F.coalesce(url, F.lit(""))
    at = F.locate("://", whole)
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return _lower(host), F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"(?s)^([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host and path, its verdict) of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def symbols(url: Column) -> Column:
    """Numbers of a URL's symbols, after two starts."""
    digits = F.translate(_lower(F.coalesce(url, F.lit(""))), "123456789", "0" * 9)
    marks = F.filter(F.split(digits, ""), lambda c: c != "")

    def number(c: Column) -> Column:
        at = F.instr(F.lit(SYMBOLS), c)
        return F.when(at == 0, len(SYMBOLS)).otherwise(at - 1)

    return F.concat(F.array(F.lit(START), F.lit(START)), F.transform(marks, number))


def trigrams(url: Column) -> Column:
    """Numbers of a URL's symbols with the two before: one number below SIZE ** 3 for each character."""
    def of(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(2), F.size(s) - 1), lambda i: (F.get(s, i - 2) * SIZE + F.get(s, i - 1)) * SIZE + F.get(s, i))

    # bound to a variable: written out, the symbols would be worked out anew for each position
    return F.when(F.length(url) > 0, F.transform(F.array(symbols(url)), of)[0]).otherwise(F.array().cast("array<int>"))


def ratios(labelled: DataFrame, weight: float = 4.0) -> DataFrame:
    """(gram, ratio): log P(symbol | the two before) for accepted less that for rejected URLs, for grams that either has.

    labelled(url, accepted): an order-2 estimate is the count plus `weight` times the order-1 estimate, over the context's
    count plus `weight`; order 1 rests on order 0 in the same way, and that on equal chances. Gram -1 - (b * SIZE + c) is the
    order-1 value and -1 - SIZE ** 2 - c the order-0 value; below these are what a context adds where the symbol after it is
    new, log of the rejected side's count plus weight over the accepted side's: ONE - b and TWO - (a * SIZE + b).
    At most SIZE ** 3 + 2 * SIZE ** 2 + 2 * SIZE rows.
    """
    grams = labelled.select("accepted", F.explode(trigrams(F.col("url"))).alias("g"))
    three = cut(grams.groupBy("accepted", "g").agg(F.count(F.lit(1)).cast("double").alias("n")), "url-grams")
    c, b = F.col("g") % SIZE, F.floor(F.col("g") / SIZE) % SIZE
    spark = labelled.sparkSession
    sides = spark.createDataFrame([(True,), (False,)], "accepted boolean")
    zero = three.groupBy("accepted", c.alias("c")).agg(F.sum("n").alias("n"))
    zero = sides.crossJoin(spark.range(SIZE).select(F.col("id").alias("c"))).join(zero, ["accepted", "c"], "left").fillna(0.0, ["n"])
    total = F.sum("n").over(Window.partitionBy("accepted"))
    zero = zero.select("accepted", "c", ((F.col("n") + weight / SIZE) / (total + weight)).alias("p0"))
    two = three.groupBy("accepted", b.alias("b"), c.alias("c")).agg(F.sum("n").alias("n"))
    seen = two.select("b", "c").distinct()
    total = F.sum("n").over(Window.partitionBy("accepted", "b"))
    two = sides.crossJoin(seen).join(two, ["accepted", "b", "c"], "left").fillna(0.0, ["n"]).join(zero, ["accepted", "c"])
    two = two.select("accepted", "b", "c", ((F.col("n") + weight * F.col("p0")) / (total + weight)).alias("p1"))
    seen = three.select("g").distinct()
    total = F.sum("n").over(Window.partitionBy("accepted", "a", "b"))
    top = sides.crossJoin(seen).join(three, ["accepted", "g"], "left").fillna(0.0, ["n"])
    top = top.select("accepted", "g", "n", F.floor(F.col("g") / SIZE**2).alias("a"), b.alias("b"), c.alias("c")).join(two, ["accepted", "b", "c"])
    top = top.select("accepted", "g", ((F.col("n") + weight * F.col("p1")) / (total + weight)).alias("p"))
    # contexts: counts of the symbols that follow
    def added(keys: Column) -> DataFrame:
        of = lambda side: F.sum(F.when(F.col("accepted") == side, F.col("n")).otherwise(0.0)) + weight
        return three.groupBy(keys.alias("g")).agg((F.log(of(False)) - F.log(of(True))).alias("ratio"))

    new = added(F.lit(ONE) - b).unionByName(added(F.lit(TWO) - F.floor(F.col("g") / SIZE)))
    every = top.unionByName(two.select("accepted", (-1 - F.col("b") * SIZE - F.col("c")).alias("g"), F.col("p1").alias("p")))
    every = every.unionByName(zero.select("accepted", (-1 - SIZE**2 - F.col("c")).alias("g"), F.col("p0").alias("p")))
    return every.groupBy("g").agg(F.sum(F.when(F.col("accepted"), F.log("p")).otherwise(-F.log("p"))).alias("ratio")).unionByName(new)


def table_of(ratio: DataFrame) -> Column:
    """The ratios as one binary literal: 4 bytes at position g have gram g's ratio, else its context's part and the shorter one's.

    SIZE ** 3 numbers, whatever the input, in steps of 1 / STEPS above -2 ** 31 / STEPS, so that sums do not depend on order.
    """
    got = {int(r["g"]): float(r["ratio"]) for r in ratio.collect()}
    flat = []
    for g in range(SIZE**3):
        ab, bc, b, c = g // SIZE, g % SIZE**2, g % SIZE**2 // SIZE, g % SIZE
        value = got.get(g)
        if value is None:
            one = got.get(-1 - bc)
            value = got.get(TWO - ab, 0.0) + (got.get(ONE - b, 0.0) + got.get(-1 - SIZE**2 - c, 0.0) if one is None else one)
        flat.append(value)
    return F.lit(b"".join((round(x * STEPS) + 2**31).to_bytes(4, "big") for x in flat))


def mean_ratio(url: Column, table: Column) -> Column:
    """Log-likelihood difference for each character; 0 for an empty URL."""
    def value(g: Column) -> Column:
        return F.conv(F.hex(F.substr(table, g.cast("int") * 4 + 1, F.lit(4))), 16, 10).cast("long") - 2**31

    total = F.aggregate(trigrams(url), F.lit(0).cast("long"), lambda acc, g: acc + value(g))
    return F.when(F.length(url) > 0, total / (F.length(url) * F.lit(float(STEPS)))).otherwise(0.0)


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page.

    The longest fitting rule decides. Where none fits, the models do: trained on the URLs that rules decide, two thirds of
    them by checksum, with the threshold set on the other third, between the two sides' mean scores in proportion to their
    spread. A URL that is null or has no :// has empty host and path. Without rule-decided URLs on both sides the threshold is 0. A score at the
    threshold allows. Ids may be null or repeat; extra columns are ignored; an empty table gives no rows.
    """
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = split_url(F.col("url"))
    p = p.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    p = p.withColumn("rule", rule).withColumn("ruled", verdict)
    labelled = p.where("ruled IS NOT NULL").select("url", (F.col("ruled") == "allow").alias("accepted"), (F.crc32(F.col("url").cast("binary")) % 3).alias("third"))
    table = table_of(ratios(labelled.where("third < 2")))
    scored = labelled.where("third = 2").select("accepted", mean_ratio(F.col("url"), table).alias("s"))
    by = {r["accepted"]: r for r in scored.groupBy("accepted").agg(F.avg("s").alias("m"), F.stddev_pop("s").alias("d")).collect()}
    threshold = 0.0
    if len(by) == 2:
        up, down = by[True], by[False]
        spread = up["d"] + down["d"]
        threshold = (up["m"] * down["d"] + down["m"] * up["d"]) / spread if spread else (up["m"] + down["m"]) / 2
    score = F.when(F.col("ruled").isNull(), mean_ratio(F.col("url"), table))
    p = p.withColumn("score", score)
    own = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return p.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
