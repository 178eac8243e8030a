"""Collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces at punctuation and line ends, pieces into words. Each position of a piece gives one gram, the longest that
starts there: five words, or fewer at the end of the piece. Grams of five words are the edges of the graph, from the node of their first
four words to that of their last four; shorter ones are what pieces leave at their ends.

* Edges are counted before the shuffle, per task.
* Unary paths (nodes with one edge in and one out, equally heavy, at which no piece ends) are compacted: edges that are heavy enough become one path
  of many words with one weight, found by pointer doubling.
* The count of a shorter phrase is the flow out of its node, the weights of all longer grams that start with it, plus the pieces that
  end with it.

Only phrases with at least `least` occurrences are wanted, and so are their parts, which occur at least as often. Hence a pair of
words below that can't lie inside such a phrase, and pieces are cut at it: all wanted counts stay exact, and grams of words that meet by chance
never leave their task. Pairs are counted by 64-bit hashes and marked in a bitmap of fixed size (2^`BITS` bits, 16 MB, the only thing
broadcast); a collision, or a bitmap that fills up on very large inputs, only leaves pieces uncut.

A phrase is dropped if a phrase one word longer is as frequent: then all its flow goes through that one edge. Whatever contains it in a
still longer phrase of equal count contains it in one of these too.

Arithmetic of scores uses decimals of 38 digits. Defined results: null or empty texts give nothing; a null language is `und`; repeated rows
count each; ties in the ranking go by count, then bytes of the phrase. Columns other than text and lang are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideway.llm.common import written

LONGEST = 5
BITS = 27                   # bitmap of frequent pairs: 2^27 bits
BLOCK = 17                  # bits of one block of it
SLICE_BYTES = 4 << 20       # text that is looked at at once; a longer document is a slice of its own
HELD = 1 << 20              # distinct pairs that a task holds before it sends them on
GRAMS = 400_000             # distinct grams likewise
MIX = np.uint64(0x9E3779B97F4A7C15)


def _plain_bytes() -> bytes:
    """A-Z to a-z, what ends pieces to a line feed, what separates words to a blank."""
    ends = set(b".,;:!?\n\x0b\x0c\r")
    return bytes(b + 32 if 65 <= b <= 90 else 10 if b in ends else 32 if b in (9, 32) else b for b in range(256))


PLAIN = _plain_bytes()


def _texts(batches):
    """(language, texts) of slices of the batches."""
    for batch in batches:
        rows = pd.DataFrame({"lang": batch.column("lang").to_pylist(), "text": batch.column("text").to_pylist()})
        for lang, some in rows.groupby("lang", sort=False):
            held, size = [], 0
            for text in some["text"]:
                if held and size + len(text) > SLICE_BYTES:
                    yield lang, held
                    held, size = [], 0
                held.append(text)
                size += len(text)
            yield lang, held


def _words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words, and for each whether the next one belongs to the same piece."""
    plain = b"\n".join(texts).translate(PLAIN)
    words = plain.split()
    if not words:
        return words, np.zeros(0, bool)
    raw = np.frombuffer(plain, np.uint8)
    gap = (raw == 32) | (raw == 10)
    begins = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    piece = np.cumsum(raw == 10)[begins]
    return words, np.append(piece[1:] == piece[:-1], False)


def _kinds(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    codes, kinds = pd.factorize(np.array(words, dtype=object))
    return codes.astype(np.int64), kinds


def _pairs(codes: np.ndarray, kinds: np.ndarray, joined: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of joined pairs, their number among the distinct ones, and the hashes of these."""
    at = np.flatnonzero(joined)
    number, pairs = pd.factorize(codes[at] * len(kinds) + codes[at + 1])
    hashes = pd.util.hash_array(np.asarray(kinds, dtype=object), categorize=False)
    salt = pd.util.hash_array(np.array([lang], dtype=object), categorize=False)[0]
    with np.errstate(over="ignore"):
        left, right = hashes[pairs // len(kinds)], hashes[pairs % len(kinds)]
        mixed = ((left ^ salt) * MIX ^ (right >> np.uint64(29)) ^ right) * MIX
        mixed ^= mixed >> np.uint64(32)
    return at, number, mixed


def _merged(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[first], np.add.reduceat(counts, first)


def pair_counts(docs: DataFrame) -> DataFrame:
    """Rows (pair, n): pairs of neighbouring words, by hash."""
    def run(batches):
        held, size = [], 0

        def send(all_of):
            hashes, counts = all_of
            for a in range(0, len(hashes), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(hashes[a:a + (1 << 18)].view(np.int64)), pa.array(counts[a:a + (1 << 18)])], names=["pair", "n"])

        for lang, texts in _texts(batches):
            words, joined = _words(texts)
            if not joined.any():
                continue
            codes, kinds = _kinds(words)
            _, number, hashes = _pairs(codes, kinds, joined, lang)
            held.append((hashes, np.bincount(number, minlength=len(hashes))))
            size += len(hashes)
            if size > HELD:
                held = [_merged(*map(np.concatenate, zip(*held, strict=True)))]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from send(held[0])
                    held, size = [], 0
        if held:
            yield from send(_merged(*map(np.concatenate, zip(*held, strict=True))))

    return docs.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def marked(pairs: DataFrame) -> np.ndarray:
    """Bitmap of the hashes in `pairs`; at most 2^(BITS - 3) bytes reach the driver, however many there are."""
    slot = F.col("pair").bitwiseAND((1 << BITS) - 1)
    slots = pairs.select(slot.alias("slot")).withColumn("block", F.shiftright("slot", BLOCK))

    def run(batches):
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            slots, of = batch.column("slot").to_numpy(), batch.column("block").to_numpy()
            for block in np.unique(of):
                bits = blocks.setdefault(int(block), np.zeros(1 << BLOCK, bool))
                bits[slots[of == block] & ((1 << BLOCK) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([np.packbits(b).tobytes() for b in blocks.values()], pa.binary())],
                                         names=["block", "bits"])

    out = np.zeros(1 << (BITS - 3), np.uint8)
    width = 1 << (BLOCK - 3)
    for row in slots.repartition("block").mapInArrow(run, "block long, bits binary").collect():
        out[row["block"] * width:(row["block"] + 1) * width] |= np.frombuffer(row["bits"], np.uint8)
    return out


def grams(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """Rows (lang, gram, n) of the longest grams within pieces cut at unmarked pairs."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        counts: dict[tuple[str, bytes], int] = {}

        def send():
            langs, texts = [k[0] for k in counts], [k[1].decode() for k in counts]
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(texts, pa.string()), pa.array(list(counts.values()), pa.int64())],
                                              names=["lang", "gram", "n"])

        bits = shared.value
        for lang, texts in _texts(batches):
            words, joined = _words(texts)
            if not words:
                continue
            codes, kinds = _kinds(words)
            if joined.any():
                at, number, hashes = _pairs(codes, kinds, joined, lang)
                slots = (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)
                frequent = (bits[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1
                joined[at] = frequent[number].astype(bool)
            code, at = codes, np.arange(len(words))
            for k in range(1, LONGEST + 1):
                # `at` are the places where k words lie within a piece, `code` numbers these grams
                last = at + k - 1
                more = joined[last] if k < LONGEST else np.zeros(len(at), bool)
                ended, first, n = np.unique(code[~more], return_index=True, return_counts=True)
                for i, m in zip(at[~more][first].tolist(), n.tolist(), strict=True):
                    gram = lang, b" ".join(words[i:i + k])
                    counts[gram] = counts.get(gram, 0) + m
                at, code = at[more], code[more]
                if not len(at):
                    break
                code, _ = pd.factorize(code * len(kinds) + codes[at + k])
            if len(counts) > GRAMS:
                yield send()
                counts = {}
        if counts:
            yield send()

    return docs.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def compact(edges: DataFrame, ends: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Paths (lang, words, n) of edges with a weight of at least `least`, and the edges (lang, gram, n) in none.

    `edges` are grams of LONGEST words, `ends` shorter ones. Within a path all inner nodes are unary. No path is a cycle: every piece begins
    and ends somewhere, which unbalances a node or gives it a second edge. Each round joins every edge with the one its pointer leads to, so the
    number of rounds is the logarithm of the longest path.
    """
    words = F.split("gram", " ")
    node = lambda start: F.concat_ws(" ", F.slice(words, start, LONGEST - 1))
    out = edges.select("lang", node(1).alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i"), F.col("n").alias("d"))
    into = edges.select("lang", node(2).alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"), (-F.col("n")).alias("d"))
    last = ends.where(F.size(words) == LONGEST - 1).select("lang", F.col("gram").alias("node"), F.lit(2).alias("o"), F.lit(2).alias("i"), F.lit(0).alias("d"))
    unary = (out.unionByName(into).unionByName(last).groupBy("lang", "node").agg(F.sum("o").alias("o"), F.sum("i").alias("i"), F.sum("d").alias("d"))
             .where("o = 1 AND i = 1 AND d = 0").select("lang", "node"))
    heavy = edges.where(F.col("n") >= least)
    before = (heavy.select("lang", F.col("gram").alias("before"), node(2).alias("node")).join(unary, ["lang", "node"]))
    state = heavy.withColumn("node", node(1)).join(before, ["lang", "node"], "left").select(
        "lang", "gram", "n", F.coalesce("before", "gram").alias("head"), F.col("before").isNotNull().cast("int").alias("far"))
    state = written(state, "paths")
    while True:
        to = state.select("lang", F.col("gram").alias("head"), F.col("head").alias("_head"), F.col("far").alias("_far"))
        state = written(state.join(to, ["lang", "head"]).select(
            "lang", "gram", "n", F.col("_head").alias("head"), (F.col("far") + F.col("_far")).alias("far"), (F.col("_far") > 0).alias("moved")), "paths")
        if state.where("moved").isEmpty():
            break
        state = state.drop("moved")
    item = F.struct("far", F.element_at(words, -1).alias("word"))
    paths = state.groupBy("lang", "head").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))
    # as long as the longest passage that is repeated as a whole
    tail = F.transform(F.slice(F.col("items"), 2, F.size("items")), lambda x: x["word"])
    return paths.select("lang", F.concat(F.split("head", " "), tail).alias("words"), "n"), edges.where(F.col("n") < least)


def phrase_counts(paths: DataFrame, light: DataFrame, ends: DataFrame, least: int) -> DataFrame:
    """Rows (lang, phrase, k, f) of phrases with at least `least` occurrences: flow out of their node plus pieces that end with them."""
    windows = paths.select("lang", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - (LONGEST - 1)), lambda i: F.slice("words", i, LONGEST))).alias("words"))
    one = lambda df: df.select("lang", "n", F.split("gram", " ").alias("words"))
    longest = windows.unionByName(one(light)).unionByName(one(ends))
    parts = longest.select("lang", "n", F.size("words").alias("whole"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words")), lambda k: F.struct(k.alias("k"), F.concat_ws(" ", F.slice("words", 1, k)).alias("phrase")))).alias("p"))
    through = F.sum(F.when(F.col("whole") > F.col("p.k"), F.col("n")).otherwise(0))
    ended = F.sum(F.when(F.col("whole") == F.col("p.k"), F.col("n")).otherwise(0))
    counted = parts.groupBy("lang", F.col("p.phrase").alias("phrase"), F.col("p.k").alias("k")).agg((through + ended).alias("f"))
    return counted.where(F.col("f") >= least)


def collocations(docs: DataFrame, *, least: int = 100, top: int = 2000) -> DataFrame:
    """The `top` phrases of two to five words per language: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.encode(F.col("text"), "UTF-8").alias("text"))
    texts = texts.where("text IS NOT NULL")
    bitmap = marked(pair_counts(texts).where(F.col("n") >= least))
    counted = written(grams(texts, bitmap), "grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    long = F.size(F.split("gram", " ")) == LONGEST
    edges, ends = counted.where(long), counted.where(~long)
    known = written(phrase_counts(*compact(edges, ends, least), ends, least), "phrases")

    words = F.split("phrase", " ")
    inner = known.where("k > 2").select("lang", "f", F.explode(F.array(
        F.concat_ws(" ", F.slice(words, 1, F.col("k") - 1)), F.concat_ws(" ", F.slice(words, 2, F.col("k") - 1)))).alias("phrase"))
    covers = inner.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    kept = (known.where("k > 1").join(covers, ["lang", "phrase"], "left").where("cover IS NULL OR cover < f")
            .select("lang", "phrase", "k", F.col("f").alias("a")))
    part = lambda a, n: F.concat_ws(" ", F.slice(words, a, n))
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"left": part(F.lit(1), F.col("cut")), "right": part(F.col("cut") + 1, F.col("k") - F.col("cut"))})
    of = lambda side, f: known.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"]).join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    cuts = cuts.withColumns({"above": wide("a") * wide("n") * F.lit(1000).cast("decimal(4,0)"), "below": wide("l") * wide("r")})
    cuts = cuts.withColumn("score", F.expr("above div below"))
    least_cut = F.min(F.struct("score", "cut", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(least_cut.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return scored.withColumn("rank", place.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
