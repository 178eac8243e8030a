"""Personal data: fixed shapes, and identifiers that bootstrapped contexts reveal.

Base spans are the leftmost non-overlapping matches of four patterns, less those that fail a check (see BASE). The contextual part starts from seeds: base
spans and tokens shaped like keys. The one to three blank-separated pieces left of an occurrence are its lexical patterns, back to the match of the same shape
before it. In each round a pattern's confidence in a kind is the score of its instances over their number (plus one, so that few prove little), and an instance's
score the chance that not all its confident patterns err; seeds stay at 1. Confidences only grow; rounds end when none grows by `settled` or more. Tokens with a digit behind a pattern that ends up confident are new spans of its kind, unless they touch a base span.

Positions are code points, ends exclusive. Null text is empty; a row of `docs` gives one row whatever it holds, repeated rows and null ids too. Extra columns are
ignored. Everything here is DataFrame functions; the text is read in one pass, and what follows moves matches only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideway.llm.common import written

# The contract's patterns. Groups that follow each other without overlap are possessive, and a run of characters is tried from its start (or the end of the
# last match) only: the same matches in linear time.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*BASE, "secret")
TOKEN_CHARS = "[A-Za-z0-9_@.+-]"
# A stretch of such characters with a digit, at least six long.
TOKEN = rf"(?<!{TOKEN_CHARS})(?=[A-Za-z_@.+-]*+[0-9]){TOKEN_CHARS}{{6,}}+"
SEED_SECRET = r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,})$"
# What a text must hold for a pattern to be tried at all.
HINTS = {"email": "@", "phone": "+"}
NEAR, LONG = 256, 64


def _found(kind: str, pattern: str) -> Column:
    """Matches with the length and the end of what lies before each."""
    hint = F.contains("text", F.lit(HINTS[kind])) if kind in HINTS else F.col("_digits")
    return F.when(hint, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))


def _valid() -> Column:
    """Whether a base match passes the check of its kind."""
    byte = "(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0+)"
    digits = F.regexp_replace("s", "[^0-9]", "")
    n = F.length(digits)
    doubled = F.aggregate(
        F.sequence(F.lit(1), n), F.lit(0),
        lambda a, i: a + F.try_element_at(
            F.when(i % 2 == 0, F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])).otherwise(F.array(*[F.lit(x) for x in range(10)])),
            F.substring(digits, n - i + 1, F.lit(1)).cast("int") + 1))
    return (F.when(F.col("kind") == "email", True)
            .when(F.col("kind") == "ip", F.col("s").rlike(rf"^{byte}(?:\.{byte}){{3}}$"))
            .when(F.col("kind") == "card", F.when(n.between(12, 19), doubled % 10 == 0).otherwise(False))
            .when(F.col("kind") == "phone", n.between(9, 15)).otherwise(False))


def _left(gap: Column) -> Column:
    """The last three pieces of what lies before, the nearest first, in lower case; a piece of more than LONG characters by its digest."""
    def pieces(x: Column) -> Column:
        return F.filter(F.split(F.lower(x), r"\s+"), lambda p: p != "")

    near = pieces(F.right(gap, F.lit(NEAR)))
    # behind a fourth piece the last three are whole
    last = F.slice(F.reverse(F.when((F.length(gap) <= NEAR) | (F.size(near) > 3), near).otherwise(pieces(gap))), 1, 3)
    return F.transform(last, lambda p: F.when(F.length(p) <= LONG, p).otherwise(F.concat(F.lit("#"), F.sha2(p.cast("binary"), 256))))


def _patterns(last: Column) -> Column:
    """The last one, two and three pieces; from a start of text or behind a match fewer."""
    joined = F.transform(F.sequence(F.lit(1), F.size(last)), lambda n: F.array_join(F.reverse(F.slice(last, 1, n)), " "))
    return F.when(F.size(last) > 0, joined)


def matches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: row, doc_id; found: row, kind, s, start, end, left, base), kind `token` for candidates."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    text = text.withColumn("_digits", F.col("text").rlike("[0-9]"))
    patterns = BASE | {"token": TOKEN}
    for kind, pattern in patterns.items():
        text = text.withColumn(f"m_{kind}", _found(kind, pattern))
    for kind, pattern in patterns.items():
        gaps = F.transform(F.slice(F.split("text", pattern, -1), 1, F.size(f"m_{kind}")), lambda g: F.struct(F.length(g).alias("n"), _left(g).alias("left")))
        text = text.withColumn(f"g_{kind}", F.when(F.size(f"m_{kind}") > 0, F.arrays_zip(gaps.alias("g"), F.col(f"m_{kind}").alias("s"))))
    scanned = written(text.select("row", "doc_id", *[f"g_{k}" for k in patterns]), "scanned")
    parts = [scanned.where(F.size(f"g_{k}") > 0).select(
        "row", F.lit(k).alias("kind"), F.posexplode(f"g_{k}").alias("k", "m")) for k in patterns]
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    every = every.select("row", "kind", "k", F.col("m.g.n").alias("gap"), F.col("m.g.left").alias("left"), F.col("m.s").alias("s"))
    before = Window.partitionBy("row", "kind").orderBy("k")
    end = F.sum(F.col("gap") + F.length("s")).over(before)
    every = every.withColumn("end", end).withColumn("start", F.col("end") - F.length("s"))
    every = every.withColumn("base", _valid()).where("base or kind = 'token'")
    return scanned.select("row", "doc_id"), written(every.select("row", "kind", "s", "start", "end", "left", "base"), "found")


def discover(found: DataFrame, *, confidence: float = 0.6, support: int = 5, settled: float = 0.001) -> DataFrame:
    """New spans (row, kind, start, end) behind confident patterns."""
    # tokens that touch a base span are not candidates
    by_start = Window.partitionBy("row").orderBy("start", F.col("base").desc())
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(by_start)
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(0, Window.unboundedFollowing))
    open_ = found.withColumn("_reach", reach).withColumn("_ahead", ahead).where(
        F.col("base") | ((F.coalesce("_reach", F.lit(0)) <= F.col("start")) & (F.coalesce("_ahead", F.lit(2**62)) >= F.col("end"))))
    seed = F.when(F.col("base"), F.col("kind")).when(F.col("s").rlike(SEED_SECRET), F.lit("secret"))
    occurrences = written(
        open_.select("row", "start", "end", "base", seed.alias("seed"), F.xxhash64("s").alias("instance"), F.explode(_patterns(F.col("left"))).alias("pattern")),
        "occurrences")
    graph = occurrences.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    # a pattern without a few seeds or neighbours proves nothing
    sizes = graph.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    graph = written(graph.join(sizes, "pattern"), "graph")
    seeds = graph.where("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scores, patterns = seeds, None
    while True:
        now = written(graph.join(scores, "instance").groupBy("pattern", "kind")
                      .agg((F.sum("score") / (F.first("n") + 1)).alias("confidence")).where(F.col("confidence") >= confidence), "patterns")
        if patterns is None:
            grown = now
        else:
            grown = now.join(patterns.withColumnRenamed("confidence", "was"), ["pattern", "kind"], "left").where(
                F.col("confidence") - F.coalesce("was", F.lit(0.0)) >= settled)
        patterns = now
        if grown.isEmpty():
            break
        told = graph.where("seed is null").join(patterns, "pattern").groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score"))
        scores = written(seeds.union(told), "scores")
    new = occurrences.where("not base").join(patterns, "pattern")
    best = Window.partitionBy("row", "start", "end").orderBy(F.desc("confidence"), "kind")
    new = new.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").select("row", "kind", "start", "end")
    # keys are what they are in any context
    keys = occurrences.where("not base and seed is not null").select("row", F.col("seed").alias("kind"), "start", "end")
    return new.join(keys, ["row", "start", "end"], "left_anti").unionByName(keys.distinct())


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per row of `docs` (doc_id, text)."""
    rows, found = matches(docs)
    base = found.where("base").select("row", "kind", "start", "end", F.lit(True).alias("base"))
    every = base.union(discover(found).withColumn("base", F.lit(False)).select("row", "kind", "start", "end", "base"))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = every.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind", "base"))).alias("spans"),
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE])

    def joined(x) -> Column:
        said = F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.coalesce(F.array_join(said, ","), F.lit(""))

    return rows.join(listed, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.filter("spans", lambda s: s["base"])).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
