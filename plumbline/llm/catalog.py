"""The operators as queries over the test tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import decontaminate
from .exact_dedup import exact_dedup
from .filter_audit import audit_filters, capitals, fewer_words, holds_any, repeated_text, repetitive
from .language_id import identify_languages
from .mixing import domains_of_labels, mix
from .near_dedup import near_duplicates
from .phrases import collocations
from .sharding import shard
from .simhash import simhash_duplicates
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .token_files import encode_documents
from .warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Shares of tokens that a training mix asks for.
MIX_WEIGHTS = {"good": 0.9, "poor": 0.07, "toxic": 0.03}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="max")


ORACLE["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
 doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)"""


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup(_table(spark, sf_dir, "documents"), window=50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op3_substring_dedup"] = r"""
WITH d AS (
 SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
 SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
 FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
covered AS (
 SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
 FROM starts JOIN (SELECT h, min(doc_id) AS first FROM starts GROUP BY h) USING (h) WHERE doc_id > first),
kept AS (
 SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
 FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
 ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
 sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op4_decontamination"] = r"""
WITH lowered AS (
 SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
b AS (
 SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
 SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
 FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
grams AS (
 SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
 FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item FROM grams JOIN windows USING (k, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (
 SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
 FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
 sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents"), shards=16)


ORACLE["op5_sharding"] = r"""
WITH RECURSIVE poly(n, k, c) AS (
 SELECT n, 0, n::BIGINT FROM range(256) AS t(n)
 UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS tab FROM poly WHERE k = 8),
d AS (
 SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, ''))::BIGINT + 1 AS size, sha256(coalesce(text, '')) AS digest,
  hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (
 SELECT doc_id, digest, size, xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(h, '..')]),
  lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) AS text_crc32
 FROM d, crc),
line AS (
 SELECT *, sum(size) OVER (ORDER BY digest, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before,
  sum(size) OVER () AS total, sum(size) OVER (PARTITION BY digest) AS group_bytes FROM sums),
grouped AS (SELECT *, min(before) OVER (PARTITION BY digest) AS group_start FROM line),
placed AS (
 SELECT doc_id, size, text_crc32, digest, CAST((CASE WHEN group_bytes * 256 <= total THEN 2 * group_start + group_bytes ELSE 2 * before + size END)
  * 16 // (2 * total) AS INTEGER) AS shard FROM grouped)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
 row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM placed"""


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages"), min_bytes=0)


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (CAST('0x' || substr(h, {5 * i + 1}, 5) AS INTEGER) >> {s}) % 32 + 1, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)
ORACLE["op7_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT page_id, strlen(t)::BIGINT AS n, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS r FROM p)
SELECT page_id, n AS payload_bytes, {_BASE32} AS payload_digest,
 CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> r THEN r END AS refers_to
FROM g"""


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = domains_of_labels(_table(spark, sf_dir, "labels"))
    mixed = mix(_table(spark, sf_dir, "documents"), labelled, MIX_WEIGHTS)
    chances = [F.col("chances")[d].alias(f"p_{d}") for d in MIX_WEIGHTS]
    return mixed.select("doc_id", "n_tokens", *chances, "rate", "copies")


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"), window=400)


ORACLE["op9_suffix_dedup"] = r"""
WITH d AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (
 SELECT doc_id, n, c, substr(h, 800 * c + 1, 1600) AS piece FROM (SELECT doc_id, n, h, unnest(range((n - 1) // 400 + 1)) AS c FROM d WHERE n >= 400)),
starts AS (
 SELECT doc_id, 400 * c + j AS i, md5(substr(piece, 2 * j + 1, 800)) AS w
 FROM (SELECT doc_id, c, piece, unnest(range(greatest(0, least(400, n - 399 - 400 * c)))) AS j FROM chunks)),
twice AS (SELECT w FROM starts GROUP BY w HAVING count(*) > 1),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM starts SEMI JOIN twice USING (w)),
runs AS (
 SELECT doc_id, min(i) AS a, max(i) + 400 AS b
 FROM (SELECT doc_id, i, count(*) FILTER (last IS NULL OR i > last + 400) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit)
 GROUP BY doc_id, run),
pieces AS (
 SELECT doc_id, a, b, substr(h, 2 * coalesce(lag(b) OVER r, 0) + 1, 2 * (a - coalesce(lag(b) OVER r, 0))) AS piece,
  CASE WHEN lead(a) OVER r IS NULL THEN substr(h, 2 * b + 1) ELSE '' END AS tail
 FROM runs JOIN d USING (doc_id) WINDOW r AS (PARTITION BY doc_id ORDER BY a)),
cut AS (
 SELECT doc_id, sum(b - a)::BIGINT AS gone, count(*) AS spans, string_agg(piece || tail, '' ORDER BY a) AS kept FROM pieces GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""


@query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=80)


ORACLE["op10_near_dedup"] = r"""
WITH RECURSIVE d AS (
 SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
 FROM documents),
s AS (
 SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
 SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
 FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
 SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
 WHERE 100 * common >= 80 * (p.n + q.n - common)),
reached AS (
 SELECT doc_id AS x, doc_id AS y FROM d
 UNION SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)"""



@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), min_count=10, longest=3, swallowed=50, top=2000)


ORACLE["op11_phrase_collocations"] = r"""
WITH pieces AS (
 SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
 FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
 SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
 FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, 4) AS s(size) WHERE len(w) >= size)),
f AS MATERIALIZED (SELECT lang, size, phrase, lang || '|' || phrase AS id, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT id, n FROM f WHERE n >= 10),
cand AS MATERIALIZED (SELECT lang, size, phrase, id, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
cuts AS (
 SELECT c.lang, c.phrase, c.id, a, k, l.n AS l, r.n AS r, (1000000::HUGEINT * a * a // (l.n::HUGEINT * r.n))::BIGINT AS score
 FROM (SELECT *, lang || '|' || array_to_string(w[1:k], ' ') AS head, lang || '|' || array_to_string(w[k + 1:size], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)) c
 JOIN often l ON l.id = c.head JOIN often r ON r.id = c.tail),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY id ORDER BY score, k) = 1),
inner_ AS (
 SELECT lang || '|' || array_to_string(w[i:i + 1], ' ') AS id, max(a) AS around
 FROM (SELECT lang, w, a, unnest([1, 2]) AS i FROM cand WHERE size = 3) GROUP BY ALL),
kept AS (SELECT scored.* FROM scored LEFT JOIN inner_ USING (id) WHERE 100 * coalesce(around, 0) < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000"""

#: Filters of the audit by their letters.
AUDITED = {
    "A": fewer_words(200),
    "B": repetitive(50),
    "C": capitals(2),
    "D": holds_any("#$%&*|"),
    "E": repeated_text,
}


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), AUDITED)


ORACLE["op12_filter_audit"] = r"""
WITH RECURSIVE d AS (
 SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
 SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
   CASE WHEN len(w) < 200 THEN 'A' END,
   CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
   CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
   CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
   CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END] AS fails
 FROM d LEFT JOIN l USING (doc_id)),
letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders(o) AS (
 SELECT f FROM letters
 UNION ALL SELECT o || f FROM orders, letters WHERE NOT contains(o, f)),
steps AS (
 SELECT o AS filter_order, s::INTEGER AS step, o[s] AS f, o[1:s - 1] AS before
 FROM orders, range(1, 6) AS r(s) WHERE length(o) = 5),
cells AS (SELECT part, list_filter(fails, lambda x: x IS NOT NULL) AS fails, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
walked AS (
 SELECT part, filter_order, step, f, n, good, toxic, list_contains(fails, f) AS own, len(fails) AS failed,
  len(list_filter(fails, lambda x: contains(before, x))) > 0 AS gone
 FROM cells, steps),
counted AS (
 SELECT part, filter_order, step, f,
  sum(CASE WHEN NOT gone AND NOT own THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN NOT gone AND own THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN gone AND own THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN own AND failed = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN NOT gone AND own AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN NOT gone AND own AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
 FROM walked GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
 (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted"""


@query
def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(_table(spark, sf_dir, "documents"), k=3, bits=3)


# XXH64 with seed 42 in 128-bit arithmetic. Fixed values of the hash function.
_P1, _P2, _P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
_P4, _P5, _SEED = 9650029242287828579, 2870177450012600261, 42
_MOD = "18446744073709551616::UHUGEINT"


def _times(value: str, factor: int) -> str:
    return f"(({value}) * {factor}::UHUGEINT % {_MOD})"


def _plus(value: str, more: str) -> str:
    return f"(({value}) + {more}) % {_MOD}"


def _turned(value: str, bits: int) -> str:
    return f"(({value}) * {1 << bits}::UHUGEINT % {_MOD} + ({value}) // {1 << 64 - bits}::UHUGEINT)"


def _number(at: str, size: int) -> str:
    """The little-endian number of ``size`` bytes at byte ``at`` of the hexadecimal text ``x``."""
    pairs = " || ".join(f"substr(x, 2 * ({at}) + {2 * i + 1}, 2)" for i in reversed(range(size)))
    return f"CAST('0x' || {pairs} AS UBIGINT)::UHUGEINT"


_STARTS = ", ".join(f"{x % 2**64}::UHUGEINT" for x in (_SEED + _P1 + _P2, _SEED + _P2, _SEED, _SEED - _P1))
#: From the distinct texts ``g`` of the CTE ``s`` to ``hashed`` (g, h): stripes of 32 bytes, words of 8, of 4, bytes, final mix.
_XXH64 = f"""lanes AS (
 SELECT g, x, n, n // 32 AS stripes, [{_times(_number('8 * i', 8), _P2)} FOR i IN range(n // 8)] AS k
 FROM (SELECT g, hex(encode(g)) AS x, strlen(g)::BIGINT AS n FROM (SELECT DISTINCT g FROM s))),
striped AS (
 SELECT *, [list_reduce(list_prepend(v0, [k[4 * t + j] FOR t IN range(stripes)]),
  lambda v, a: {_times(_turned("(v + a) % " + _MOD, 31), _P1)}) FOR v0, j IN [{_STARTS}]] AS v FROM lanes),
merged AS (
 SELECT *, CASE WHEN stripes = 0 THEN {(_SEED + _P5) % 2**64}::UHUGEINT ELSE list_reduce(list_prepend(
  ({_turned('v[1]', 1)} + {_turned('v[2]', 7)} + {_turned('v[3]', 12)} + {_turned('v[4]', 18)}) % {_MOD},
  [{_times(_turned('a', 31), _P1)} FOR a IN [{_times('b', _P2)} FOR b IN v]]),
  lambda h, a: {_plus(_times('xor(h, a)', _P1), f'{_P4}::UHUGEINT')}) END AS h0 FROM striped),
worded AS (
 SELECT g, x, n, list_reduce(list_prepend({_plus('h0', 'n::UHUGEINT')}, [{_times(_turned('a', 31), _P1)} FOR a IN k[4 * stripes + 1:]]),
  lambda h, a: {_plus(_times(_turned('xor(h, a)', 27), _P1), f'{_P4}::UHUGEINT')}) AS h FROM merged),
halved AS (
 SELECT g, x, n, CASE WHEN n % 8 >= 4 THEN {_plus(_times(_turned('xor(h, four)', 23), _P2), f'{_P3}::UHUGEINT')} ELSE h END AS h
 FROM (SELECT *, CASE WHEN n % 8 >= 4 THEN {_times(_number('8 * (n // 8)', 4), _P1)} END AS four FROM worded)),
ended AS (
 SELECT g, list_reduce(list_prepend(h, [{_times(_number('i', 1), _P5)} FOR i IN range(4 * (n // 4), n)]),
  lambda h, a: {_times(_turned('xor(h, a)', 11), _P1)}) AS h FROM halved),
mixed AS (SELECT g, {_times(f'xor(h, h // {1 << 33}::UHUGEINT)', _P2)} AS h FROM ended),
mixed_again AS (SELECT g, {_times(f'xor(h, h // {1 << 29}::UHUGEINT)', _P3)} AS h FROM mixed),
hashed AS MATERIALIZED (SELECT g, xor(h, h // {1 << 32}::UHUGEINT)::UBIGINT AS h FROM mixed_again)"""

_SET_BITS = ", ".join(f"sum((h >> {b}) & 1) AS b{b}" for b in range(64))
_MAJORITY = " + ".join(f"CASE WHEN 2 * b{b} > n THEN {1 << b}::UBIGINT ELSE 0 END" for b in range(64))
ORACLE["op13_simhash_dedup"] = rf"""
WITH RECURSIVE d AS (
 SELECT doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
 FROM documents),
s AS MATERIALIZED (
 SELECT doc_id, array_to_string(w[i:i + 2], ' ') AS g
 FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
{_XXH64},
counted AS (SELECT doc_id, count(*) AS n, {_SET_BITS} FROM s JOIN hashed USING (g) GROUP BY doc_id),
prints AS MATERIALIZED (
 SELECT doc_id, coalesce(p, 0)::UBIGINT AS p FROM d LEFT JOIN (SELECT doc_id, {_MAJORITY} AS p FROM counted) USING (doc_id)),
nodes AS MATERIALIZED (SELECT p, min(doc_id) AS least FROM prints GROUP BY p),
links AS MATERIALIZED (SELECT a.p AS x, b.p AS y FROM nodes a, nodes b WHERE bit_count(xor(a.p, b.p)) BETWEEN 1 AND 3),
reached AS (SELECT p AS x, p AS y FROM nodes UNION SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
component AS (SELECT x AS p, min(least) AS component_id FROM reached JOIN nodes ON nodes.p = reached.y GROUP BY x)
SELECT doc_id, format('{{:016x}}', p) AS fingerprint, component_id FROM prints JOIN component USING (p)"""
