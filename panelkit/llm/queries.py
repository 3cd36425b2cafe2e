"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.llm import collocations, jaccard, mixing, packing, pii, quality, sharding, substring, topk, toxicity, urls, variants, warc
from panelkit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "windows", "top_window")


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query("op3_substring_dedup", sql=r"""
WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - 48)) AS i FROM d)),
dup AS (SELECT doc_id, i FROM win JOIN (SELECT g, MIN(doc_id) AS m FROM win GROUP BY 1) USING (g) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM dup, range(50) t(j)),
word AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, COALESCE(n, 0)::BIGINT AS n_removed, sha256(COALESCE(t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, COUNT(*) AS n FROM gone GROUP BY 1) USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op6_top_k_search", sql="""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op7_n_gram_jaccard_join", sql=r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 3, CASE WHEN len(ws) > 0 THEN 2 ELSE 1 END))) AS i FROM d)),
size AS (SELECT doc_id, COUNT(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS o FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pairs JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y)
SELECT d.doc_id, COALESCE(n, 0)::BIGINT AS n_shingles, least(d.doc_id, m) AS component_id FROM d LEFT JOIN size USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, MIN(y) AS m FROM reach GROUP BY 1) USING (doc_id)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op8_url_filters")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


_WORD = r"[^\x20\x09-\x0D]+"
_CLASSES = ", ".join([f"length(regexp_replace(text, '{p}', '', 'g'))" for p in
                      ("[^a-z]+", "[^A-Z]+", "[^0-9]+", r"[^\p{L}]|[a-zA-Z]")])
_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.COMMON_WORDS))
_JS = "CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END"


@query("op9_quality_rules", sql=rf"""
WITH t AS (SELECT doc_id, lang, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - 1)) AS i FROM t)),
rep AS (SELECT doc_id, COUNT(DISTINCT i + j) AS n FROM (SELECT *, COUNT(*) OVER (PARTITION BY doc_id, g) AS c FROM win), range(3) k(j)
  WHERE c > 1 GROUP BY 1),
m AS (SELECT t.*, len(ws)::BIGINT AS n_words, COALESCE(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines, [{_CLASSES}] AS known,
  COALESCE(rep.n, 0)::BIGINT AS n_repeat_words FROM t LEFT JOIN rep USING (doc_id)),
c AS (SELECT *, list_concat(known, [length(text) - word_chars, n_symbols, word_chars - n_symbols - list_sum(known)]) AS classes FROM m),
cl AS (SELECT doc_id, lang, n_words, unnest(classes)::DOUBLE AS n, unnest(range({quality.N_CLASSES})) AS k FROM c),
cw AS (SELECT doc_id, lang, n_words, w, COUNT(*)::DOUBLE AS n FROM (SELECT doc_id, lang, n_words, lower(unnest(ws)) AS w FROM c)
  WHERE w IN ({_LIST}) GROUP BY ALL),
big AS (SELECT lang FROM c WHERE lang IS NOT NULL GROUP BY 1 HAVING SUM(n_words) >= {quality.MIN_REFERENCE_WORDS}),
own AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE 'l' || lang END AS ref FROM c WHERE lang IS NULL OR lang IN (SELECT lang FROM big)),
rc AS (SELECT ref, k, n / SUM(n) OVER (PARTITION BY ref) AS q FROM (SELECT 'l' || lang AS ref, k, SUM(n) AS n FROM cl SEMI JOIN big USING (lang) GROUP BY 1, 2
  UNION ALL SELECT '', k, SUM(n) FROM cl GROUP BY 2)),
rw AS (SELECT ref, w, n / SUM(n) OVER (PARTITION BY ref) AS q FROM (SELECT 'l' || lang AS ref, w, SUM(n) AS n FROM cw SEMI JOIN big USING (lang) GROUP BY 1, 2
  UNION ALL SELECT '', w, SUM(n) FROM cw GROUP BY 2)),
dc AS (SELECT doc_id, sqrt(greatest(0, SUM({_JS.format(p='p', q='q')}) / 2)) AS d
  FROM (SELECT doc_id, k, n / NULLIF(SUM(n) OVER (PARTITION BY doc_id), 0) AS p FROM cl WHERE n_words >= {quality.MIN_WORDS})
  JOIN own USING (doc_id) JOIN rc USING (ref, k) GROUP BY 1),
dw AS (SELECT doc_id, sqrt(greatest(0, (SUM({_JS.format(p='p', q='q')}) + 1 - SUM(q)) / 2)) AS d FROM (SELECT doc_id, p, COALESCE(q, 0) AS q
  FROM (SELECT doc_id, w, n / SUM(n) OVER (PARTITION BY doc_id) AS p, SUM(n) OVER (PARTITION BY doc_id) AS a FROM cw WHERE n_words >= {quality.MIN_WORDS})
  JOIN own USING (doc_id) LEFT JOIN rw USING (ref, w) WHERE a >= {quality.MIN_COMMON}) GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT COALESCE(dc.d > {quality.MAX_CLASS_DISTANCE}, FALSE)
  AND NOT COALESCE(dw.d > {quality.MAX_WORD_DISTANCE}, FALSE) AS kept
FROM c LEFT JOIN dc USING (doc_id) LEFT JOIN dw USING (doc_id)""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op11_warc", sql="""
WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages),
g AS (SELECT h, MAX(page_id) AS m FROM p WHERE strlen(h) >= 1000 GROUP BY 1)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN m > page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN m > page_id THEN m END AS refers_to,
  TRUE AS intact FROM p LEFT JOIN g USING (h)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), scale.scratch(spark, "warc"), payload=False)


_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op12_phrase_collocations", sql=rf"""
WITH p AS (SELECT COALESCE(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex({_LOWER}, '[.,;:!?
-
]')), '[^ 	]+') AS ws
  FROM documents),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) v(k))),
f AS (SELECT lang, k, g, COUNT(*) AS a FROM g GROUP BY ALL HAVING COUNT(*) >= 10),
w AS (SELECT *, string_split(g, ' ') AS ws FROM f WHERE k > 1),
cut AS (SELECT w.lang, w.g, w.a, c, l.a AS l, r.a AS r, (1000000::HUGEINT * w.a * w.a // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM w) w JOIN f l ON l.lang = w.lang AND l.g = array_to_string(ws[1:c], ' ')
  JOIN f r ON r.lang = w.lang AND r.g = array_to_string(ws[c + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
held AS (SELECT lang, array_to_string(ws[i:i + 1], ' ') AS g, MAX(a) AS longer FROM w, (VALUES (1), (2)) v(i) WHERE k = 3 GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN held USING (lang, g) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n::BIGINT AS n, score
FROM kept JOIN (SELECT lang, SUM(len(ws)) AS n FROM p GROUP BY 1) USING (lang) QUALIFY rank <= 2000""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))
