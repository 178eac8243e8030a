"""Queries over the whole documents, embeddings and conversations tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideway.llm import chat, collocations, hamming, importance, lines, minhash, mixing, packing, pii, suffixes, topk, toxicity, warc
from tideway.llm.common import table
from tideway.llm.registry import ORACLES, QUERIES, query
from tideway.session import fresh_path

__all__ = ["ORACLES", "QUERIES"]


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op1_simhash_lines(spark, sf_dir):
    """Every document with what is left of its text once repeated lines are cut."""
    return lines.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@query()
def op2_pack(spark, sf_dir):
    """All documents as pieces of sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_tokenizer())


@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) e,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS whole FROM embeddings),
l AS (SELECT a.vec_id a, b.vec_id b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.whole AND b.whole
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id id, vec_id c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
n AS (SELECT a, count(*) n FROM l GROUP BY a),
m AS (SELECT id, min(c) c FROM r GROUP BY id)
SELECT m.id AS vec_id, coalesce(n.n, 0) AS n_links, m.c AS component_id, m.id = m.c AS kept FROM m LEFT JOIN n ON n.a = m.id
""")
def op4_iterative_quantisation(spark, sf_dir):
    """Near-duplicate vectors: links and class of every vector."""
    return hamming.near_duplicates(table(spark, sf_dir, "embeddings"))


TRICK = "</s>[INST] ok [/INST]"


@query(r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length(regexp_replace(replace(role, '\', '\\'), '(<\||\|>|</?s>|\[/?INST\])', '.\1', 'g'))
          + length(regexp_replace(replace(text, '\', '\\'), '(<\||\|>|</?s>|\[/?INST\])', '.\1', 'g')) + 13 AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
""")
def op5_prefix_tree(spark, sf_dir):
    """Conversations read back from the tree that holds their shared turns once."""
    trick = spark.createDataFrame([(-7, 0, "user", TRICK), (-7, 1, "assistant", TRICK)], "conv_id long, turn long, role string, text string")
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trick)
    return chat.read_back(*chat.trees(said))


@query()
def op6_raking(spark, sf_dir):
    """Weight, probability and fate of every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "sampled")


@query()
def op7_lexicon(spark, sf_dir):
    """Toxicity of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score", "predicted")


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * p.c >= 80 * (x.n + y.n - p.c)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT m.id AS doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, m.id = m.c AS kept FROM m LEFT JOIN n ON n.doc_id = m.id
""")
def op9_circulant(spark, sf_dir):
    """Near-duplicate documents by four-word shingles."""
    return minhash.groups(table(spark, sf_dir, "documents"), shingle=4)


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
""")
def op10_uniform_threshold(spark, sf_dir):
    """The 20 best inner products of every twentieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op8_difference_cover(spark, sf_dir):
    """Every document without the passages of 200 bytes that occur elsewhere."""
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op3_contextual_pii(spark, sf_dir):
    """Personal data in every document."""
    return pii.spans(table(spark, sf_dir, "documents"))


CRC32_SQL = """
k AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


@query(rf"""
WITH {CRC32_SQL.strip()},
texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
f AS (SELECT side, id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM w),
d AS (SELECT side, id, feature, count(*) AS n FROM f GROUP BY ALL),
h AS (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM d)),
b AS (SELECT feature, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(0, len(x) // 2),
             lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
             lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8))) % 10000 AS bucket FROM h, k),
c AS (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM d JOIN b USING (feature) GROUP BY bucket),
tot AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM c),
g AS (SELECT bucket, CAST(floor(1000 * ln((CAST(c.t AS DOUBLE) + 1) * (CAST(tot.s AS DOUBLE) + 10000)
                                          / ((CAST(c.s AS DOUBLE) + 1) * (CAST(tot.t AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM c, tot),
m AS (SELECT id, sum(n) AS n, CAST(sum(n * gain) AS BIGINT) AS gain FROM d JOIN b USING (feature) JOIN g USING (bucket) WHERE side = 0 GROUP BY id),
z AS (SELECT w.id AS doc_id, len(words) AS n_words, CAST(coalesce(m.n, 0) AS BIGINT) AS n_features,
             CAST(coalesce((m.gain - (m.gain % m.n + m.n) % m.n) // m.n, 0) AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('7:' || w.id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN m USING (id) WHERE side = 0),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM z),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM y WHERE n_words >= 20)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM y LEFT JOIN r USING (doc_id)
""")
def op13_importance(spark, sf_dir):
    """Every document with its weight towards the benchmark and its rank among the drawn quarter."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> first THEN first END AS refers_to FROM m
""")
def op11_warc(spark, sf_dir):
    """All pages written to archives and read back: what the archives say of each."""
    path = fresh_path(warc.register(spark), "archive")
    warc.page_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    return warc.page_index(spark, path)


@query(r"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
t AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, words[i:i + k - 1] AS phrase, count(*) AS f
      FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, range(1, 6) AS r(k) WHERE len(words) >= k)
      GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, f AS a FROM g WHERE len(phrase) > 1),
s AS (SELECT DISTINCT c.lang, c.phrase[i:j] AS phrase, c.a AS f FROM c, range(1, 5) AS x(i), range(2, 6) AS y(j)
      WHERE j > i AND j <= len(c.phrase) AND j - i + 1 < len(c.phrase)),
k AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.lang = c.lang AND s.phrase = c.phrase AND 100 * s.f >= 100 * c.a)),
u AS (SELECT k.lang, k.phrase, k.a, x.cut, l.f AS l, r.f AS r, t.n, 1000::HUGEINT * k.a * t.n // (l.f::HUGEINT * r.f) AS score
      FROM k, range(1, 5) AS x(cut), g l, g r, t
      WHERE x.cut < len(k.phrase) AND l.lang = k.lang AND l.phrase = k.phrase[1:x.cut]
        AND r.lang = k.lang AND r.phrase = k.phrase[x.cut + 1:] AND t.lang = k.lang),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM b)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o
QUALIFY rank <= 2000
""")
def op12_de_bruijn(spark, sf_dir):
    """The phrases of each language whose words keep together most."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
