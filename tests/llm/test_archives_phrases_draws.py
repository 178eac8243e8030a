"""WARC archives, collocations and importance resampling against plain versions and on awkward tables."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideway.llm import collocations, importance, warc
from tideway.session import fresh_path

DOCS = "doc_id long, text string, lang string, score string, n string, rank string, _above int, words string"
PAGES = "page_id long, url string, html string, record_type string, payload string, _same int"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- importance resampling -------------------------------------------------------------------------


def test_checksums():
    rng = random.Random(4)
    flat = np.frombuffer(rng.randbytes(300_000), np.uint8)
    lengths = np.array([0, 1, 3, 4, 511, 512, 513, 1024, 1025, 100_000, 250_001] * 3)
    starts = np.array([rng.randrange(len(flat) - n + 1) for n in lengths])
    got = importance.checksums(flat, starts, lengths)
    assert got.tolist() == [zlib.crc32(flat[s:s + n].tobytes()) for s, n in zip(starts, lengths)]


def brute_draw(docs, target, least=20, percent=25, seed=7, buckets=10_000):
    def features(text):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))
        return len(words), [zlib.crc32(f.encode()) % buckets for f in words + [a + " " + b for a, b in zip(words, words[1:])]]

    mine = [(d, *features(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in mine for b in f), Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (big_s + buckets) / ((s[b] + 1.0) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for d, n, f in mine:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    for i, r in enumerate(able):
        r.append(i + 1 if i < len(able) * percent // 100 else None)
    return sorted([tuple(r) if len(r) == 6 else (*r, None) for r in rows], key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(60)]
    out = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(150)]
    out += [None, "", " ,. ", "a", "A\x00b\x7fC Éa", "x" * 3000 + " " + "y" * 700 + " z" * 40, "word " * 20_000, out[3], out[3].upper(), "中文没有空格 的 词"]
    return [(None if i == 5 else i, t, ["en", None, "de"][i % 3], "x", "y", "z", i, "w") for i, t in enumerate(out)] + [(7, out[7], "en", "x", "y", "z", 1, "w")]


@pytest.mark.parametrize("least,percent,slice_rows", [(20, 25, 20_000), (1, 100, 3), (5, 1, 7)])
def test_importance(spark, texts, monkeypatch, least, percent, slice_rows):
    target = [texts[1][1], "new words only", None, "中文没有空格"]
    docs = spark.createDataFrame(texts, DOCS).repartition(3)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    monkeypatch.setattr(importance, "SLICE_ROWS", slice_rows)
    rows = importance.resample(docs, items, least_words=least, percent=percent).collect()
    assert sorted(map(tuple, rows), key=repr) == brute_draw([r[:2] for r in texts], target, least, percent)


def test_importance_of_nothing(spark, texts):
    docs, items = spark.createDataFrame(texts, DOCS), spark.createDataFrame([], "item_id long, text string")
    assert importance.resample(docs.limit(0), items).count() == 0
    rows = importance.resample(docs, items).collect()
    assert sorted(map(tuple, rows), key=repr) == brute_draw([r[:2] for r in texts], [])


def test_longer_runs(spark):
    n_words, n_runs, codes = importance.hashed_runs([b"a b c", b"", b"d"], 3, 1 << 16)
    wanted = [b"a", b"a b", b"a b c", b"b", b"b c", b"c", b"d"]
    assert n_words.tolist() == [3, 0, 1] and n_runs.tolist() == [6, 0, 1]
    assert codes.tolist() == [zlib.crc32(w) % (1 << 16) for w in wanted]


# -- collocations ----------------------------------------------------------------------------------


def brute_phrases(docs, least, top):
    counts, total = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i:i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    often = {p: c for p, c in counts.items() if c >= least and len(p[1]) > 1}
    covered = {(lang, p[i:j]) for (lang, p), c in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
               if j - i < len(p) and c >= counts[lang, p[i:j]]}
    rows = []
    for (lang, p), a in often.items():
        if (lang, p) in covered:
            continue
        n = total[lang]
        cuts = [(1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        rows.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], n, score))
    out = []
    for lang in total:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def chatter():
    rng = random.Random(2)
    words = ["w%d" % i for i in range(25)] + ["É", "x"]
    passage = " ".join(rng.choices(words, k=60))
    out = []
    for i in range(400):
        parts = [" ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(1, 12))) for _ in range(rng.randint(1, 6))]
        if rng.random() < 0.3:
            parts.insert(rng.randint(0, len(parts)), passage)
        if rng.random() < 0.2:
            parts.append("one two three four five six seven")
        out.append(rng.choice([". ", "\n", " ; ", "\x0b", ", "]).join(parts))
    out += [None, "", " \t ", "x " * 500, "X\tx x x.x x", "...", out[0], out[0]]
    return [(t, ["en", "de", None][i % 5 % 3]) for i, t in enumerate(out)]


@pytest.mark.parametrize("least,top", [(2, 10**6), (10, 50), (100, 2000), (10**6, 5)])
def test_collocations(spark, chatter, least, top):
    docs = spark.createDataFrame([(i, t, lang, "s", "n", "r", 1, "w") for i, (t, lang) in enumerate(chatter)], DOCS).repartition(4)
    rows = collocations.collocations(docs, least=least, top=top).collect()
    assert sorted(map(tuple, rows)) == brute_phrases(chatter, least, top)


@pytest.mark.parametrize("bits", [0, 0xFF])
def test_collocations_need_no_bitmap(spark, chatter, monkeypatch, bits):
    """A bitmap that is full (or filled by collisions) only leaves pieces uncut."""
    if bits:
        monkeypatch.setattr(collocations, "marked", lambda pairs: np.full(1 << (collocations.BITS - 3), bits, np.uint8))
    monkeypatch.setattr(collocations, "HELD", 50)
    monkeypatch.setattr(collocations, "GRAMS", 30)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 500)
    docs = spark.createDataFrame(chatter, "text string, lang string").repartition(3)
    rows = collocations.collocations(docs, least=30).collect()
    assert sorted(map(tuple, rows)) == brute_phrases(chatter, 30, 2000)


def test_paths_are_compacted(spark):
    """A passage that is repeated as a whole becomes one path."""
    words = [f"p{i}" for i in range(40)]
    grams = Counter()
    for text in [words] * 6 + [words[:20] + ["other", "end", "of", "it", "all"]] * 2:
        grams.update(" ".join(text[i:i + 5]) for i in range(len(text)))
    rows = spark.createDataFrame([("en", g, n) for g, n in grams.items()], "lang string, gram string, n long")
    long = F.size(F.split("gram", " ")) == 5
    paths, light = collocations.compact(rows.where(long), rows.where(~long), 3)
    got = sorted((r["n"], " ".join(r["words"])) for r in paths.collect())
    assert got == [(6, " ".join(words[16:])), (8, " ".join(words[:20]))]
    assert light.count() == 5


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, "", "", "", 1, "")], DOCS)).count() == 0


# -- archives ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(6)
    body = lambda n: "".join(rng.choices("abé<>\r\n ", k=n))
    big, embedded = body(3000), "x" * 1000 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
    html = [body(rng.randint(0, 4000)) for _ in range(60)] + [big] * 5 + [None, "", "short", "short", embedded, embedded, "\r\n\r\n" * 400, "y" * 999, "y" * 999, "z" * 1000, "z" * 1000]
    urls = ["http://a.example/1", None, "http://b.example/ä b\r\nWARC-Type: x", ""]
    return [(None if i == 70 else i, urls[i % 4], h, "x", "y", i) for i, h in enumerate(html)] + [(61, "u", big, "x", "y", 0), (64, "u", big, "x", "y", 0)]


def brute_index(pages):
    first = {}
    for page, _, html, *_ in pages:
        raw = (html or "").encode()
        if len(raw) >= 1000:
            first[raw] = max(first.get(raw, -1), -1 if page is None else page)
    rows = []
    for page, _, html, *_ in pages:
        raw = (html or "").encode()
        again = len(raw) >= 1000 and first[raw] != (-1 if page is None else page)
        rows.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"maxFileBytes": "5000"}, {"compression": "none", "maxFileBytes": "3000"}])
def test_archive(spark, pages, options):
    warc.register(spark)
    path = fresh_path(spark, "archive")
    records = warc.page_records(spark.createDataFrame(pages, PAGES).repartition(3))
    records.write.format("warc").options(**options).mode("append").save(path)
    assert sorted(map(tuple, warc.page_index(spark, path).collect()), key=repr) == brute_index(pages)
    whole = spark.read.format("warc").load(path)
    rows = whole.where("record_type <> 'warcinfo'").collect()
    assert len(rows) == len(pages) and all(r["http_status"] == 200 and r["headers"]["warc-type"] == r["record_type"] for r in rows)
    for r in rows:
        assert r["record_type"] == "revisit" or hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
        assert r["target_uri"] is None or r["target_uri"].isascii() and " " not in r["target_uri"]


PREDICATES = [
    "record_type = 'revisit'", "record_type <> 'response'", "record_type in ('warcinfo', 'revisit')", "target_uri is null", "target_uri is not null",
    "target_uri like 'http://a%'", "target_uri like '%b%'", "target_uri like '%1'", "content_length > 1500", "content_length <= 1500 and record_type = 'response'",
    "not (record_type = 'response')", "refers_to is null or content_length < 10", "target_uri <=> null", "http_status = 200", "record_type = null",
    "not (target_uri like 'http://a%')", "record_id between 'urn:x-page:2' and 'urn:x-page:4'",
]


@pytest.mark.parametrize("where", PREDICATES)
def test_pushed_predicates(spark, pages, where):
    """Pushed or not, the same records come back."""
    warc.register(spark)
    path = fresh_path(spark, "archive")
    warc.page_records(spark.createDataFrame(pages, PAGES)).write.format("warc").mode("append").save(path)
    whole = spark.read.format("warc").load(path)
    kept = spark.createDataFrame(whole.collect(), whole.schema)
    key = ["record_id", "record_type", "offset", "file"]
    assert sorted(map(repr, whole.where(where).select(key).collect())) == sorted(map(repr, kept.where(where).select(key).collect()))


class Counted:
    """A file that counts the bytes that are read."""

    def __init__(self, raw):
        self.raw, self.at, self.read_bytes = raw, 0, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        out = self.raw[self.at:self.at + n]
        self.at += len(out)
        self.read_bytes += len(out)
        return out


@pytest.mark.parametrize("zipped", [False, True])
def test_unwanted_payloads_are_jumped_over(zipped):
    rng = random.Random(1)
    pack = warc.member if zipped else bytes
    records = [warc.encoded({"record_id": f"r{i}", "record_type": "response", "payload": rng.randbytes(5_000_000)}, "2020-01-01T00:00:00Z") for i in range(4)]
    raw = b"".join(map(pack, records))
    file = Counted(raw)
    rows = list(warc.records_of(file, len(raw), zipped, [lambda r: r["record_id"] == "r2"], ["record_id"], "f"))
    assert [r["record_id"] for r in rows] == ["r2"] and file.read_bytes < len(raw) / 3
    assert b"".join(records) == (gzip.decompress(raw) if zipped else raw)


def test_foreign_archives(spark, tmp_path):
    """Files without manifest: members that don't tell their length, other record types, folded headers; damaged ones are an error."""
    warc.register(spark)
    head = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:a>\r\nX-Note: one\r\n two\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(head) + gzip.compress(head.replace(b"hello", b"later")))
    (tmp_path / "b.warc").write_bytes(head)
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert sorted(bytes(r["payload"]) for r in rows) == [b"hello", b"hello", b"later"]
    assert {r["headers"]["x-note"] for r in rows} == {"one two"} and {r["http_status"] for r in rows} == {None}
    (tmp_path / "c.warc").write_bytes(head[:-8])
    with pytest.raises(Exception, match="cut off"):
        spark.read.format("warc").load(str(tmp_path / "c.warc")).collect()


def test_overwrite_and_append(spark, pages):
    warc.register(spark)
    path = fresh_path(spark, "archive")
    records = warc.page_records(spark.createDataFrame(pages[:10], PAGES))
    count = lambda: spark.read.format("warc").load(path).where("record_type <> 'warcinfo'").count()
    for mode, n in (("append", 10), ("append", 20), ("overwrite", 10)):
        records.write.format("warc").mode(mode).save(path)
        assert count() == n
    records.limit(0).write.format("warc").mode("overwrite").save(path)
    assert count() == 0
