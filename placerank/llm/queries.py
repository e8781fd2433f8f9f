"""The operators over their whole tables with production parameters, and SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from placerank.llm import exact, lm, merkle, mixing, packing, quality, sharding, simhash, squares, substring, toxicity, vectors, warc
from placerank.llm.common import LOWER, UPPER

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def tokenizer_file() -> str:
    """Where the public vocabulary lies; installed on every executor with its package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


@query()
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query(r"""
WITH s AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS o
  FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM s GROUP BY source),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight,
             CASE k % 3 WHEN 0 THEN 0.5e0 WHEN 1 THEN 0e0 ELSE -0.5e0 END AS slope, 2e0 * source_size AS cap FROM g),
l AS (  -- the level with the sources of least cap per weight full; the right one is the first that leaves none above
  SELECT *, row_number() OVER (ORDER BY cap / weight, k) AS i, (1.5e0 * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT min_by(level, i) FILTER (WHERE weight * level <= cap) AS level FROM l),
t AS (SELECT w.*, least(weight * v.level, cap) AS target FROM w, v),
e AS (SELECT sum(target) AS at, sum(target * slope) AS sl FROM t),
p AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.slope, round(t.target)::BIGINT AS goal,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY o, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS bef
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, goal - bef)) + greatest(0, least(size, goal - bef - source_size)))::BIGINT AS taken
FROM p""")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.in_order(mixing.mix(table(spark, sf_dir, "documents"))).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file()).drop("row")


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
b AS (  -- 5 hexadecimal digits are 20 bits, 4 characters of base32
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER w THEN max(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY payload_digest)""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.x = e.vec_id) AS n_links,
       least(e.vec_id, coalesce((SELECT min(y) FROM r WHERE r.x = e.vec_id), e.vec_id)) AS component_id,
       e.vec_id <= coalesce((SELECT min(y) FROM r WHERE r.x = e.vec_id), e.vec_id) AS kept
FROM embeddings e""")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query(r"""
WITH d AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS k FROM s),
m AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS first FROM h) WHERE first < doc_id),
c AS (SELECT doc_id, list(DISTINCT q) AS gone FROM (SELECT doc_id, unnest(range(p, p + 50)) AS q FROM m) GROUP BY doc_id),
k AS (SELECT d.doc_id, d.w, coalesce(c.gone, []) AS gone FROM d LEFT JOIN c USING (doc_id)),
e AS (SELECT doc_id, q, w[q] AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS q FROM k)),
o AS (SELECT e.doc_id, array_to_string(list(e.t ORDER BY e.q), ' ') AS kept FROM e
      ANTI JOIN (SELECT doc_id, unnest(gone) AS q FROM c) g ON e.doc_id = g.doc_id AND e.q = g.q GROUP BY e.doc_id)
SELECT k.doc_id, len(k.w)::BIGINT AS n_words, len(k.gone)::BIGINT AS n_removed, sha256(coalesce(o.kept, '')) AS kept_sha256
FROM k LEFT JOIN o USING (doc_id)""")
def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_held_out(table(spark, sf_dir, "documents"))



def _leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in fields) + ")"


#: crc32 of a short text, bit by bit: SQL has no such function
_CRC32 = """xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT),
  lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
  4294967295::BIGINT))"""


@query(f"""
WITH RECURSIVE d AS (SELECT *, coalesce({_CRC32} % 7 = 0, false) AS hit FROM documents),
l AS (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, {_leaf("n_chars + CASE WHEN hit THEN 1 ELSE 0 END")} AS shown FROM d),
r AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS k, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS id FROM l),
b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY id) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM r),
t(k, lev, i, n, h) AS (
  SELECT k, 0, i, n, leaf FROM b
  UNION ALL SELECT k, lev + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY k, lev, i // 2),
s AS (SELECT k, lev AS top, h AS subroot FROM t WHERE n = 1),
u(lev, i, n, h) AS (
  SELECT 0, k, (SELECT count(*) FROM s), subroot FROM s
  UNION ALL SELECT lev + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lev, i // 2),
p AS (  -- one row per leaf and level: the sibling, null if there is none, and whether it stands left
  SELECT b.id, a.lev AS step, x.h AS sib, (b.i >> a.lev) & 1 = 1 AS is_left
  FROM b JOIN s USING (k) JOIN (SELECT DISTINCT k, lev FROM t WHERE n > 1) a USING (k)
  LEFT JOIN t x ON x.k = b.k AND x.lev = a.lev AND x.i = xor(b.i >> a.lev, 1)
  UNION ALL
  SELECT b.id, s.top + a.lev, x.h, (b.k >> a.lev) & 1 = 1
  FROM b JOIN s USING (k) CROSS JOIN (SELECT DISTINCT lev FROM u WHERE n > 1) a
  LEFT JOIN u x ON x.lev = a.lev AND x.i = xor(b.k >> a.lev, 1)),
f(id, step, h) AS (
  SELECT id, 0, shown FROM b
  UNION ALL SELECT f.id, f.step + 1, sha256(CASE WHEN p.sib IS NULL THEN f.h WHEN p.is_left THEN p.sib || f.h ELSE f.h || p.sib END)
  FROM f JOIN p ON p.id = f.id AND p.step = f.step),
e AS (SELECT id, max_by(h, step) AS folded FROM f GROUP BY id),
q AS (SELECT id, sha256(coalesce(string_agg(sib, '' ORDER BY step), '')) AS proof FROM p GROUP BY id)
SELECT b.doc_id, b.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       e.folded AS folded_root, e.folded = (SELECT h FROM u WHERE n = 1) AS verified
FROM b JOIN s USING (k) JOIN e USING (id) LEFT JOIN q USING (id)""")
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(table(spark, sf_dir, "documents"))


@query()
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return squares.find_runs(table(spark, sf_dir, "documents"), plant=True)


@query()
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
