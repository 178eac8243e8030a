"""Each operator against a plain version or an exact round trip, and on awkward tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tideway.llm import chat, hamming, lines, minhash, mixing, packing, pii, suffixes, topk, toxicity
from tideway.llm.common import components
from tideway.llm.queries import word_tokenizer

DOCS = "doc_id bigint, text string, lang string, source string, score string, topic string, n_lines string, _x int"


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    said = [" ".join(rng.choices(words, k=rng.randint(3, 60))) for _ in range(60)]
    texts = ["\n".join(rng.sample(said, rng.randint(1, 8))) for _ in range(40)]
    long = "\n".join(" ".join(rng.choices(words, k=40)) for _ in range(400))
    texts += [None, "", "   \n\n", "a", long, long.replace(words[0], words[1], 3), texts[0], texts[0] + " more words", texts[1].upper(), "\x1c\u0130Σ<|endoftext|> é it's 12"]
    return [(None if i == 5 else i, t, ["en", "de", None][i % 3], f"s{i % 4}", "x", "y", "z", i) for i, t in enumerate(texts)] + [(7, texts[7], "en", "s1", "x", "y", "z", 1)]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def classes(ids, links):
    of = {i: i for i in ids}
    while True:
        new = dict(of)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == of:
            return of
        of = new


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 450)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    of = classes({x for p in links for x in p}, links)
    assert got == {i: of[i] for p in links if p[0] != p[1] for i in p}


def test_lines(spark, docs, nothing, corpus):
    rows = lines.dedup(docs).collect()
    assert len(rows) == len(corpus) and rows[0]["n_lines"] is not None
    left = Counter(" ".join(w) for r in rows for line in (r["text"] or "").split("\n") if len(w := line.lower().split()) >= 3)
    assert set(left.values()) == {1}  # each line of at least three words once
    had = {" ".join(line.lower().split()) for r in corpus for line in (r[1] or "").split("\n")}
    assert set(left) <= had and sum(r["n_removed"] for r in rows) > 50
    assert [r["text"] for r in rows if r["_x"] == 40] == [None]
    assert lines.dedup(nothing).count() == 0
    base = " ".join(f"word{i}" for i in range(60))
    near = spark.createDataFrame([(1, base), (2, base.replace("word7 ", "other ")), (3, " ".join(f"x{i}" for i in range(60)))], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in lines.dedup(near).collect()} == {1: 0, 2: 1, 3: 0}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return row[-1]


def test_lines_recall(spark):
    """Pairs with similarities from 0.8 up: whatever brute force links is linked."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(3000)]
    pairs = []
    for n in [*range(4, 31), 40, 60, 90]:
        for _ in range(6):
            base = rng.choices(vocabulary, k=n)
            other = list(base)
            for _ in range(rng.randint(1, max(1, n // 5))):
                at, kind = rng.randrange(len(other)), rng.random()
                other[at:at + (kind < 0.8)] = [] if 0.6 <= kind < 0.8 else [rng.choice(vocabulary)]
            pairs.append((base, other))
    rows = [(2 * k + side, " ".join(w)) for k, pair in enumerate(pairs) for side, w in enumerate(pair)]
    near = [k for k, (a, b) in enumerate(pairs) if a == b or _distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup(docs, most_bits=96).collect()}
    assert len(near) > 150 and {k for k, n in got.items() if n} == {2 * k + 1 for k in near}


def test_short_lines(spark):
    """Equal lines of one or two words, or without blanks, are repeats as well; similar ones without blanks are compared by characters."""
    chinese = "今天天气很好我们一起去公园散步"
    texts = ["Home\nread more\n" + chinese, "home!\nRead More\nreads more", chinese + "\n--\n\n" + chinese.replace("公", "花"), "--\n\nお早う", "お早う\nお早い"]
    got = {r["doc_id"]: (r["n_removed"], r["text"]) for r in lines.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: (0, texts[0]), 1: (2, "reads more"), 2: (2, "--\n"), 3: (0, texts[3]), 4: (1, "お早い")}


def test_lines_of_templates(spark):
    """Pairs of long lines that differ in their longest words, with the query's own parameters: at least nine tenths are linked, and nothing else is."""
    rng = random.Random(12)
    pairs = []
    for k in range(60):
        base = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(40)]
        at = rng.sample(range(40), 6) if k % 2 else range(3, 40, 7)
        sides = [[f"identifier{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(base)] for _ in range(2)]
        pairs.append(sides)
    rows = [(2 * k + side, " ".join(w)) for k, pair in enumerate(pairs) for side, w in enumerate(pair)]
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(got[2 * k] for k in range(60)) and sum(got[2 * k + 1] for k in range(60)) >= 54


def test_lines_in_one_bucket(spark):
    """Many lines with a run in common, in groups that have no other: whatever brute force links is linked, across blocks too."""
    rng = random.Random(2)
    groups = [["".join(rng.choices("abcdefghij", k=4)) for _ in range(9)] for _ in range(150)]
    said = [["one", "two", "three", *(f"x{rng.randrange(10**6)}" if j == side else w for j, w in enumerate(g))] for g in groups for side in range(-1, 3)]
    of = classes(range(len(said)), [(a, b) for a in range(len(said)) for b in range(a) if a // 4 == b // 4 or _distance(said[a], said[b]) <= 2])
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(said)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup(docs, most_bits=128).collect()}
    assert got == {i: int(c != i) for i, c in of.items()}


def test_line_numbers():
    """Edit distances of bit vectors, slices of any size and equal rows."""
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 90))) for _ in range(2))
        assert lines.distance(a, b) == _distance(a, b)
    texts = ["a b\n\nc\n", None, "", "\n\n", "d e f " * 50 + "\ng", "h"]
    for size in (1, 5, 10**6):
        before, lines.SLICE = lines.SLICE, size
        try:
            parts = [lines._Lines(p) for p in lines._slices(texts)]
        finally:
            lines.SLICE = before
        found = [x for p in parts for x in zip(p.row.tolist(), p.line.tolist(), p.n.tolist(), strict=True)]
        assert found == [(0, 0, 2), (0, 2, 1), (4, 0, 150), (4, 1, 1), (5, 0, 1)]


def test_lines_of_equal_rows(spark):
    rows = [(None, "one two three\n--\nfour", 1), (None, "one two three\n--\nfour", 2), (3, "Four!\nfive", 3), (3, "Four!\nfive", 4), (4, None, 5)]
    got = lines.dedup(spark.createDataFrame(rows, "doc_id long, text string, t int")).collect()
    assert sorted((r["text"] or "", r["n_lines"], r["n_removed"]) for r in got) == [
        ("", 0, 0), ("", 2, 2), ("--", 3, 2), ("five", 2, 1), ("one two three\n--\nfour", 3, 0)]
    assert sorted(r["t"] for r in got) == [1, 2, 3, 4, 5]


def test_packing(docs, nothing, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    pieces = packing.pack_documents(docs.coalesce(1), word_tokenizer(), group_tokens=5000).collect()
    want = Counter(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in corpus)
    seen, by_sequence = Counter(), {}
    by_doc = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], p["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at and n > 0
            at += n
        assert at <= 2048
    for (_, n), spans in by_doc.items():
        copies = sum(length for _, length in spans) // n
        assert sorted(spans)[0][0] == 0 and sum(length for _, length in spans) == copies * n
        seen[n] += copies
    assert seen == want
    padding = sum(2048 - n for s in by_sequence.values() if (n := sum(x for _, x in s)) & (n - 1))
    assert padding <= 2048 * (sum(k * n for k, n in want.items()) // 5000 + 1)
    assert packing.pack_documents(nothing, word_tokenizer()).count() == 0


def test_pack_ids(corpus):
    from tokenizers import Tokenizer

    tokenizer, words = Tokenizer.from_file(word_tokenizer()), packing.Words(word_tokenizer(), room=50)
    for _, text, *_ in corpus:
        assert words.ids(text, 1).tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_pii(spark, nothing):
    texts = ["mail a@b.c_d@e.f and x@y.z.w", "1.2.3.4.5.6.7.8 999.1.1.1 0.0.0.0 00256.1.1.1", "4111 1111 1111 1111, 4111-1111-1111-1112", None, "",
             "😀 +1 (980) 555-9331", "x" * 30000 + "@a.bb " + "1 2 3 " * 10000]
    rows = {r["doc_id"]: r for r in pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[0]["spans"] == "email:5:10,email:10:16,email:21:28" and rows[0]["n_email"] == 3
    assert (rows[1]["n_ip"], rows[2]["n_card"], rows[5]["spans"], rows[3]["spans"]) == (3, 1, "phone:2:19", "")
    assert rows[4]["base_sha256"] == hashlib.sha256(b"").hexdigest() and rows[6]["n_email"] == 1
    seeds = [(i, f"so {i} say api_key: {hashlib.md5(str(i).encode()).hexdigest()} end") for i in range(30)]
    unseen = [(100, "and then api_key: 77ab12cd90 end"), (101, "nothing like 77ab12cd90 here")]
    rows = {r["doc_id"]: r["spans"] for r in pii.spans(spark.createDataFrame(seeds + unseen, "doc_id long, text string")).collect()}
    assert rows[100] == "secret:18:28" and rows[101] == ""
    assert pii.spans(nothing).count() == 0


SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _holds(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        luhn = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and luhn % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def _plain_spans(texts):
    """Per text (counts, base spans, all spans): the docstring of the module in loops."""
    occurrences, base = [], []
    for row, text in enumerate(texts):
        found = []
        for kind, pattern in {**SHAPES, "token": pii.TOKEN}.items():
            last = 0
            for m in re.finditer(pattern, text or "", re.ASCII):
                pieces = re.split(r"\s+", text[last:m.start()].lower(), flags=re.ASCII)
                last = m.end()
                if kind == "token" or _holds(kind, m.group()):
                    found.append((kind, m.group(), m.start(), m.end(), [p for p in pieces if p][-3:]))
        own = [f for f in found if f[0] != "token"]
        base.append(sorted((s, pii.KINDS.index(k), e) for k, _, s, e, _ in own))
        for k, said, s, e, left in found:
            if k == "token" and any(s < b[3] and b[2] < e for b in own):
                continue
            seed = k if k != "token" else "secret" if re.search(pii.SEED_SECRET, said) else None
            occurrences.append((row, s, e, k != "token", seed, said, [tuple(left[-n:]) for n in range(1, len(left) + 1)]))
    instances, seeds = {}, {}
    for *_, seed, said, patterns in occurrences:
        for p in patterns:
            instances.setdefault(p, set()).add(said)
            if seed:
                seeds[p, said] = seed
    instances = {p: x for p, x in instances.items() if len(x) >= 5}
    seeds = {k: v for k, v in seeds.items() if k[0] in instances}
    known = {(said, kind): 1.0 for (_, said), kind in seeds.items()}
    scores, was = dict(known), None
    while True:
        now = {}
        for p, members in instances.items():
            for kind in pii.KINDS:
                c = sum(scores.get((said, kind), 0.0) for said in members) / (len(members) + 1)
                if c >= 0.6:
                    now[p, kind] = c
        if was is not None and all(c - was.get(k, 0.0) < 0.001 for k, c in now.items()):
            break
        was, scores = now, dict(known)
        wrong = {}
        for (p, kind), c in now.items():
            for said in instances[p]:
                if (p, said) not in seeds:
                    wrong[said, kind] = wrong.get((said, kind), 1.0) * max(1 - c, 1e-9)
        for k, w in wrong.items():
            scores[k] = scores.get(k, 0.0) + 1 - w
    every = [list(b) for b in base]
    for row, s, e, is_base, seed, _, patterns in occurrences:
        told = [(-c, kind) for p in patterns for (q, kind), c in now.items() if p == q]
        if not is_base and (seed or told):
            every[row].append((s, pii.KINDS.index(seed or min(told)[1]), e))

    def joined(spans):
        return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))

    return [(*[sum(k == i for _, k, _ in b) for i in range(4)], hashlib.sha256(joined(b).encode()).hexdigest(), joined(x)) for b, x in zip(base, every, strict=True)]


def test_pii_against_loops(spark):
    """The tables' documents, random strings of the shapes' characters, chains of contexts that take several rounds, and long pieces that differ far left only."""
    rng = random.Random(8)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["".join(rng.choices("a@.1203 -+()\n", k=rng.randint(0, 120))) for _ in range(300)]
    code = lambda: "".join(rng.choices("abcdef0123456789", k=12)) + "7"
    texts += [f"login token: {hashlib.md5(str(i).encode()).hexdigest()} done" for i in range(240)]
    shared, at = [code() for _ in range(60)], len(texts)
    texts += [f"{'login token:' if step == 0 else f'step {step}x'} {c} {step}" for step in range(9) for c in shared[4 * step:4 * step + 24]]
    far = "x" * 300
    texts += [f"so {side}{far} {hashlib.md5(f'{side}{i}'.encode()).hexdigest() if side == 'a' else code()}" for side in "ab" for i in range(12)]
    texts += [f"then a{far} {code()}"]
    rows = pii.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    want = _plain_spans(texts)
    assert len(rows) == len(texts) and [i for i, w in enumerate(want) if got[i] != w] == []
    assert "secret" in want[-1][-1] and want[-2][-1] == "" and sum("secret" in w[-1] for w in want[at:at + 9 * 24]) > 200


def _vectors(n=300, d=32, seed=2):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, d))
    v[50:80] = v[:30] + 0.05 * rng.standard_normal((30, d))
    v[100] = v[101] = v[102]
    rows = [(i, [float(x) for x in v[i]]) for i in range(n)]
    return rows + [(1000, None), (1001, [float("nan")] * d), (1002, [0.0] * d), (1003, [None] * d), (1004, []), (None, rows[0][1]), (1005, [1.0, 2.0])]


def test_hamming(spark):
    rows = _vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in hamming.near_duplicates(frame, sample=200, block_rows=8).collect()}
    whole = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and i < 1000]
    unit = np.stack([v / np.linalg.norm(v) for _, v in whole])
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    found = sum(got[i]["n_links"] for i, _ in whole)
    assert 0.9 * near.sum() <= found <= near.sum() and got[100]["n_links"] == 2 and got[102]["component_id"] == 100
    of = classes([i for i, _ in whole], list(zip(*np.nonzero(near), strict=True)))
    assert all(of[got[i]["component_id"]] == of[i] for i, _ in whole)
    assert all(got[i]["kept"] and got[i]["n_links"] == 0 for i in range(1000, 1006)) and len(got) == len(rows) - 1
    assert hamming.near_duplicates(frame.where("vec_id > 2000")).count() == 0


def _pairs(d, n, rng, at=0.951, shift=0.0):
    """n vectors around `shift` and n more, each at cosine `at` to one of them."""
    x = rng.standard_normal((n, d)) + shift
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.standard_normal((n, d))
    noise -= (noise * x).sum(axis=1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return np.concatenate([x, at * x + np.sqrt(1 - at * at) * noise])


def test_hamming_recall(spark):
    """Pairs hardly above the threshold, in tables of several numbers of components, one of them first with few vectors; and vectors far from the origin."""
    rng = np.random.default_rng(5)
    rows, links, start = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0])], {2: 2}, 10
    for d, shift in ((12, 0.0), (24, 0.0), (32, 0.0), (48, 0.0), (65, 1.0), (128, 0.0)):
        v = _pairs(d, 600, rng, shift=shift)
        rows += [(start + i, [float(x) for x in r]) for i, r in enumerate(v)]
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        links[d] = int((unit @ unit.T >= 0.95).sum()) - len(v)
        start += len(v)
    size = {i: len(v) for i, v in rows}
    got = Counter()
    for r in hamming.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=64).collect():
        got[size[r["vec_id"]]] += r["n_links"]
    assert got[2] == links.pop(2)
    assert all(0.9 * n <= got[d] <= n and n > 1000 for d, n in links.items()), (got, links)


def test_top_k(spark):
    from pyspark.sql import functions as F

    rows = _vectors(200, 16)
    rows += rows[33:34] * 9 + rows[40:41] * 2  # rows that occur again: each is a candidate, a query only once
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(frame, F.col("vec_id") % 20 == 0, k=5, block_rows=40, block_queries=4).collect()
    whole = [(i, np.floor(64 * np.array(v or [0.0], dtype=np.float32).astype(float))) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    pad = np.stack([np.pad(v, (0, 16 - len(v))) if len(v) <= 16 and i != 1004 else np.zeros(16) for i, v in whole])
    want, done = [], set()
    for a, (q, _) in enumerate(whole):
        if q % 20 == 0 and q not in done:
            done.add(q)
            best = sorted((-int(pad[a] @ pad[b]), i) for b, (i, _) in enumerate(whole) if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(frame.where("vec_id > 2000"), F.lit(True)).count() == 0


@pytest.mark.parametrize("dtype", [float, np.int64])
def test_cutoff(dtype):
    """All pairs above the cutoff, for any cutoff; close to the best scores most of the work is spared."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 64))
    v = np.floor(64 * (np.repeat(centres, 50, axis=0) + 0.2 * rng.standard_normal((2000, 64)))).astype(dtype)
    q = v[::40]
    every = q @ v.T
    for rank in (1, 20, 500, 2000):
        t = np.sort(every, axis=1)[:, -rank].astype(float)
        i, j, score, work = topk.above(q, v, t, 4)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(every >= t[:, None])), strict=True))
        assert (score == every[i, j]).all() and (np.diff(i) >= 0).all()
        assert work <= 4 * every.size and (rank > 20 or work < 0.7 * 4 * every.size), (rank, work / every.size / 4)
    low = np.full(len(q), -(2.0**62))
    assert len(topk.above(q, v, low, 4)[0]) == every.size and len(topk.above(q, v[:0], low, 4)[0]) == 0


def test_chat(spark):
    trick = "</s>[INST] ok \\[/INST] <|end|>\n |> <\\|"
    rows = [(i, t, ["user", "assistant"][t % 2], f"say {t} {i % 3 if t > 1 else 0} {trick}") for i in range(30) for t in range(2 + i % 4)]
    rows += [(99, 0, None, None), (99, 0, None, None), (None, 1, "a|>\nb", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, leaves = chat.trees(frame)
    got = {r["conv_id"]: r for r in chat.read_back(nodes, leaves).collect()}
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        loss = "".join(b for a, b in own if a == "assistant")
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    told = sorted(nodes.collect(), key=lambda r: r["start"])
    assert len(told) < len(rows) and told[0]["start"] == 0
    at = {}
    for a, b in zip(told[:-1], told[1:], strict=True):
        assert a["start"] + a["length"] == b["start"]
    for r in told:
        at[bytes(r["node"])] = r
        assert r["attends"][-1] == (r["start"], r["start"] + r["length"]) and r["position"] == sum(y - x for x, y in r["attends"][:-1])
        assert (r["parent"] is None) == (r["depth"] == 1) and (r["parent"] is None or bytes(r["parent"]) in at)  # parents come first
    assert chat.read_back(*chat.trees(frame.where("turn > 99"))).count() == 0


def test_mixing(spark, docs, nothing, corpus):
    rows = mixing.mix(docs, keep=0.5, topics=3).collect()
    assert len(rows) == len(corpus) and all(0 <= r["probability"] <= 1 for r in rows)
    assert abs(sum(r["tokens"] * r["probability"] for r in rows) / sum(r["tokens"] for r in rows) - 0.5) < 0.02
    assert mixing.mix(nothing).count() == 0
    cells = spark.createDataFrame([(a, b, c, 10 + 7 * i) for i, (a, b, c) in enumerate((a, b, c) for a in "xy" for b in "pq" for c in "01")],
                                  "source string, lang string, topic string, tokens long")
    shares = {"source": [("x", 0.7), ("y", 0.3)], "lang": [("p", 0.5), ("q", 0.5)], "topic": [("0", 0.2), ("1", 0.8)]}
    raked = mixing.rake(cells, {k: spark.createDataFrame(v, f"{k} string, share double") for k, v in shares.items()}, tolerance=1e-6).collect()
    total = sum(r["weight"] * r["tokens"] for r in raked)
    for side, wanted in shares.items():
        for value, share in wanted:
            assert abs(sum(r["weight"] * r["tokens"] for r in raked if r[side] == value) / total - share) < 1e-4


def test_mixture(spark):
    """Expected tokens have the wanted shares, though a common source has to be thinned out and a rare one can't be repeated."""
    sizes = {("hot", "en"): 400, ("hot", "de"): 100, ("mid", "en"): 250, ("mid", "de"): 150, ("rare", "en"): 40, ("rare", "de"): 60}
    rows = [(i, "word other third", s, x) for i, (s, x) in enumerate(k for k, n in sizes.items() for _ in range(n))]
    targets = {"source": {"hot": 0.35, "mid": 0.45, "rare": 0.2}, "lang": {"en": 0.5, "de": 0.5}, "topic": {str(k): 1.0 for k in range(8)}}
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for keep, reached in ((0.3, 0.3), (None, 0.5)):  # all of the rare source is a fifth of half of the tokens
        got = mixing.mix(docs, targets=targets, keep=keep, topics=1).collect()
        total = sum(r["tokens"] * r["probability"] for r in got)
        assert abs(total / sum(r["tokens"] for r in got) - reached) < 0.01
        for side in ("source", "lang"):
            for value, share in targets[side].items():
                assert abs(sum(r["tokens"] * r["probability"] for r in got if r[side] == value) / total - share) < 0.005


@pytest.mark.parametrize("keep", [None, 0.8])
def test_mixture_by_cells_in_spark(spark, monkeypatch, keep):
    """Cells that stay in Spark, as they are many, give the same probabilities to the last bit, cells held at 1 among them."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["word", "other", "third"], k=rng.randint(1, 60))), rng.choices(["a", "b", None, "d"], [90, 6, 3, 1])[0],
             rng.choices(["en", "de", None], [9, 3, 1])[0]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = lambda: {r["doc_id"]: (r["weight"], r["probability"], r["sampled"]) for r in mixing.mix(docs, flatten=0.3, keep=keep, topics=2).collect()}
    near = mixed()
    monkeypatch.setattr(mixing, "MOST_CELLS", 0)
    assert mixed() == near and (keep is None or any(p == 1 for _, p, _ in near.values()))


def test_texts_are_profiled_once(spark, monkeypatch):
    seen, real = spark.sparkContext.accumulator(0), mixing.profile

    def counted(text):
        seen.add(1)
        return real(text)

    monkeypatch.setattr(mixing, "profile", counted)
    docs = spark.createDataFrame([(i, f"word {i % 7} other" if i else None, "s", "en") for i in range(50)], "doc_id long, text string, source string, lang string")
    assert mixing.mix(docs, topics=2).count() == 50 and seen.value == 50


def test_topics_of_all(spark):
    """Means and centres come from all documents, not from the sample that the first centres are drawn from."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdef" if i % 2 else "uvwxyz", k=200)) for i in range(300)] + ["".join(rng.choices("klmnop", k=200))]
    langs = ["en"] * 300 + ["rare"]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(zip(texts, langs, strict=True))], "doc_id long, text string, lang string")
    learned = mixing.learn_topics(docs, topics=2, sample=2, rounds=3)
    of = np.stack([mixing.profile(t) for t in texts])
    assert set(learned.means) == {"en", "rare"} and np.allclose(learned.means["en"], of[:300].mean(axis=0), atol=1e-6)
    assert np.allclose(learned.mean, of.mean(axis=0), atol=1e-6)
    points = learned.apart(of, langs)
    near = (points @ learned.centres.T).argmax(axis=1)
    again = np.stack([points[near == k].sum(axis=0) for k in range(2)])
    again /= np.linalg.norm(again, axis=1, keepdims=True)
    assert len(set(near)) == 2 and (again * learned.centres).sum(axis=1).min() > 0.95


def test_toxicity(spark, nothing):
    rng = random.Random(4)
    clean = ["".join(rng.choices("qwertzuiop", k=5)) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(clean, k=30) + (["you", "stupid", "scum"] if i % 4 == 0 else []))) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(0, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, labels)
    assert {" scum ", " stupid "} <= set(model.weights)
    odd = [(1, "such $tup1d people", "a"), (2, "ѕсum of the earth", "a"), (3, "stupid simple recipes", "a"), (4, "fine words here", "a"), (5, None, "a"), (6, "", "a"),
           (7, "s\u200bcum", "a"), (8, " ".join(clean * 50), "a")]
    got = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(odd, "doc_id long, text string, score string"), model).collect()}
    assert [got[i]["predicted"] for i in range(1, 9)] == [1, 1, 0, 0, 0, 0, 1, 0]
    held = [(r["doc_id"] % 4 == 0) == bool(r["predicted"]) for r in toxicity.score(docs, model).where("crc32(cast(doc_id as string)) % 3 = 1").collect()]
    assert sum(held) == len(held) > 50
    empty = toxicity.fit(docs, labels.where("toxic = 0"))
    assert toxicity.score(docs, empty).where("predicted = 1").count() == 0 and toxicity.score(nothing, model).count() == 0


def test_strength():
    """Hits inside phrases against a plain comparison of all with all, and a text of many of both."""
    rng = random.Random(9)
    weights = {" bad ": 4.0, " ba": 1.0, " worse ": 5.0, " it bad ": 2.0}
    automaton = toxicity._automaton(toxicity.Model(weights, ("not bad it", "it bad", "bad worse bad"), 1.0, 0.0))
    phrases = [" not bad it ", " it bad ", " bad worse bad "]
    for n in [*range(60), 100_000]:
        words = rng.choices(["not", "bad", "it", "worse", "band"], k=n)
        got = toxicity._strength(automaton, " ".join(words))
        if n < 60:
            text = " ".join(("", *words, ""))
            at = {p: [i for i in range(len(text)) if text.startswith(p, i)] for p in [*phrases, *weights]}
            spared = [(i, i + len(p)) for p in phrases for i in at[p]]
            total = sum(w for p, w in weights.items() for i in at[p] if p not in phrases and not any(a <= i and i + len(p) <= b for a, b in spared))
            assert got == pytest.approx(total / np.log2(8 + n)), words
    assert got > 0


def test_learned_exceptions(spark):
    """A phrase that only clean documents hold takes nothing from the word's weight elsewhere."""
    from pyspark.sql import functions as F

    rng = random.Random(6)
    clean = ["".join(rng.choices("qwertzuiop", k=5)) for _ in range(300)]
    rows = [(i, " ".join([*rng.choices(clean, k=15), *(["you", "scum"] if i % 4 == 0 else ["pond", "scum"] if i % 100 == 1 else []), *rng.choices(clean, k=15)]))
            for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"), exceptions=())
    assert " scum " in model.weights and "pond scum" in model.exceptions and "you scum" not in model.exceptions
    odd = spark.createDataFrame([(1, "green pond scum here"), (2, "vile scum here"), (3, "p0nd scum and scum")], "doc_id long, text string")
    assert [r["predicted"] for r in toxicity.score(odd, model).orderBy("doc_id").collect()] == [0, 1, 1]
    blank = toxicity.fit(docs.withColumn("text", F.lit("")), spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    assert blank.weights == {} and toxicity.score(odd, blank).where("predicted = 1").count() == 0
    single = spark.createDataFrame([(i, "scum" if i % 4 == 0 else "pond") for i in range(400)], "doc_id long, text string")  # no two words anywhere
    assert toxicity.fit(single, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int"), exceptions=()).exceptions == ()


@pytest.mark.parametrize("collide", [False, True])
def test_suffixes(docs, nothing, corpus, collide, monkeypatch):
    """Also if all strings have equal first fingerprints."""
    if collide:
        monkeypatch.setattr(suffixes.Chunk, "fingerprints", lambda self, at, n: np.full(len(at), 5, dtype=np.uint64))
    rows = suffixes.remove_repeats(docs, chunk_bytes=3000, bucket_bytes=2000).collect()
    texts = [(t or "").encode() for _, t, *_ in corpus]
    count = Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    want = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[t[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        want.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    assert sorted(tuple(r)[1:5] for r in rows) == sorted(want)
    assert suffixes.remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("length", [5, 40, 200, 500])
def test_difference_cover(length):
    v, cover = suffixes.difference_cover(length)
    assert {(a - b) % v for a in cover for b in cover} == set(range(v)) and v <= max(1, length / 2)


def test_minhash(docs, nothing, corpus):
    got = minhash.groups(docs, shingle=2, block_sets=4).collect()
    sets = []
    for i, t, *_ in corpus:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k:k + 2]) for k in range(max(1, len(w) - 1))} if w else set()))
    index = {k: (i is None, i) for k, (i, _) in enumerate(sets)}
    links = [(a, b) for a, (_, x) in enumerate(sets) for b, (_, y) in enumerate(sets) if a < b and x and 100 * len(x & y) >= 80 * len(x | y)]
    of = classes(range(len(sets)), links)
    heads = {c: min((index[k] for k in of if of[k] == c)) for c in of.values()}
    want = sorted((str(sets[k][0]), len(sets[k][1]), str(heads[of[k]][1])) for k in of)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    assert sum(r["kept"] for r in got) == len(set(of.values()))
    assert minhash.groups(nothing).count() == 0


def test_linked_lines_of_any_length_have_a_key_in_common():
    """One word in five differs, and those are long, so that runs without them come late; with 16 keys a line some pairs had none in common."""
    rng, missed = np.random.default_rng(3), []
    word = lambda letters: "".join(chr(97 + c) for c in rng.integers(0, 26, letters))
    for n in (*range(10, 60), *range(60, 210)):
        one = [word(20 if i % 5 == 4 else 3) for i in range(n)]
        two = [word(20) if i % 5 == 4 else x for i, x in enumerate(one)]
        of, key = lines._Lines([(0, 0, " ".join(one) + "\n" + " ".join(two))]).keys(np.ones(2, dtype=bool), 0.8, 3)
        if not set(key[of == 0].tolist()) & set(key[of == 1].tolist()):
            missed.append(n)
    assert not missed


def test_rounds_read_profiles_in_packs(spark, monkeypatch):
    """A row holds many profiles of a language; sums are those of single vectors, to the last bit."""
    monkeypatch.setattr(mixing, "PACK", 7)
    texts = [(f"text {i * i} {'abc' * (i % 5)}", [None, "en", "fr"][i % 3]) for i in range(100)]
    known = spark.createDataFrame([(lang, np.asarray(mixing.profile(t), dtype=np.float32).tobytes()) for t, lang in texts], "lang string, p binary").coalesce(1)
    packs = mixing._packs(known)
    assert packs.count() == 15 and sum(len(r["p"]) for r in packs.collect()) == 100 * 4 * mixing.SIZE
    sums = mixing._sums(packs, lambda points, lang: ([str(lang), "none"], np.zeros(len(points), dtype=np.int64), points))
    assert sorted(sums) == ["None", "en", "fr"]
    for name, s in sums.items():
        points = [mixing.profile(t).astype(np.float32).astype(np.float64) for t, lang in texts if str(lang) == name]
        assert s[-1] == len(points) and np.array_equal(s[:-1], np.rint(np.stack(points) * mixing.UNIT).sum(axis=0))


def test_a_written_table_leaves_no_shuffle_files(spark):
    from tideway.llm.common import written

    files = lambda: spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("shuffle_")
    before = files()
    out = written(spark.range(1000).repartition(3, "id").groupBy("id").count(), "counts")
    assert files() <= before and out.count() == 1000


def test_keys_are_shuffled_in_packs(spark):
    """Six bytes for a key and its line, a row for a task's keys of a bucket; the lines that meet are those that plain groups of keys give."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(60)]
    lists = [rng.choices(words, k=rng.randint(3, 40)) for _ in range(300)]
    made = lines._Lines([(0, 0, "\n".join(" ".join(x) for x in lists))])
    text = made.symbols()
    said = [text[a:a + n] for a, n in zip(made.start.tolist(), made.n.tolist(), strict=True)]
    numbers = [(i % 3 << 33) + 70_000 * i for i in range(len(said))]  # of several files, beyond 16 bits
    coded = spark.createDataFrame(list(zip(numbers, said, strict=True)), "id long, text string").repartition(3).cache()
    counts = lines._symbol_counts(coded)
    assert counts.sum() == len(text) and counts[ord(text[0])] == text.count(text[0])
    packed = lines._packed(coded, counts, 5, 0.8, 3).cache()
    common = np.round(np.log2(counts + 1.0) * 256).astype(np.uint64)
    symbol = np.frombuffer(text.encode("utf-16-le"), dtype="<u2")
    of, key = lines._Lines.of_symbols(symbol, made.n).keys(np.ones(len(said), dtype=bool), 0.8, 3, common[symbol])
    assert sum(len(r["entries"]) for r in packed.collect()) == 6 * len(key)
    groups = {}
    for line, k in zip(of.tolist(), key.tolist(), strict=True):
        groups.setdefault(k, set()).add(numbers[line])
    got = {}
    for r in lines._shared(packed).collect():
        got.setdefault(r["key"], []).append((r["id"], r["n"]))
    assert all(len(ids) == len(set(ids)) == n for ids in got.values() for _, n in ids)
    assert sorted(sorted(i for i, _ in ids) for ids in got.values()) == sorted(sorted(ids) for ids in groups.values() if len(ids) > 1)


def test_pairs_are_verified_once(spark):
    """Two lines of different classes that share many keys are one pair; blocks with many pairs give a forest."""
    base = [chr(0x900 + i) for i in range(60)]
    coded = [(i, "".join(base[:50] + [chr(0x1000 + 20 * i + j) for j in range(10)])) for i in range(4)]
    frame = lines._coded(spark.createDataFrame([(i, i, x) for i, x in coded], "id long, g long, text string"))
    rows = spark.createDataFrame([(k, i, i, 0) for k in range(30) for i in range(4)], "key long, id long, component long, head long")
    asked = []

    def verify(pairs, lines_):
        asked.extend(pairs.collect())
        return pairs

    before = lines.PAIRS
    try:
        links = lines._settle(rows, frame, verify, 0.8, 128)
        assert sorted(map(tuple, asked)) == [(a, b) for a in range(4) for b in range(a)] and links.count() == 6
        lines.PAIRS = 0
        asked.clear()
        links = {tuple(r) for r in lines._settle(rows, frame, verify, 0.8, 128).collect()}
    finally:
        lines.PAIRS = before
    assert not asked and set(classes(range(4), links).values()) == {0}
