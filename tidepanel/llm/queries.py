"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, embedding_dedup, exact_dedup, language_id, licenses, packing, quality, simhash, spelling, substring_dedup, topk, url_filter
from .tables import read


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(n: int):
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language_id.learn(docs.where(remainder(4) != 2))
    own = docs.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "text")
    return language_id.predict(own, model, ["doc_id", "held_out"])


def op2_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_documents(docs, vocabulary_path()).drop("ids")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality.learn(docs.where(remainder(3) != 1), labels)
    own = docs.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "text")
    return quality.score(own, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, vocabulary_path())


#: The contract's rules: verdict, host, path. OP9_SQL is still made from ``url_filter.RULES``, which blocks net/de/.
OP9_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return url_filter.judge(pages, url_filter.rule_table(spark, OP9_RULES)).drop("component")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removals(read(spark, sf_dir, "documents", "doc_id", "text"))


def slip(doc_id, run):
    """One run in 199 loses a letter: which, and where, by the crc32 of id and run."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % 199 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(read(spark, sf_dir, "documents", "doc_id", "text"), change=slip))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents", "text", "lang"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), largest=True)


def queries() -> dict:
    return {
        "op1_language_id": op1_language_id,
        "op2_bpe_encoding": op2_bpe_encoding,
        "op3_license_scan": op3_license_scan,
        "op4_embedding_near_dedup": op4_embedding_near_dedup,
        "op5_exact_top_k": op5_exact_top_k,
        "op6_simhash_near_dedup": op6_simhash_near_dedup,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_url_filters": op9_url_filters,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_exact_dedup": op13_exact_dedup,
    }


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0"

OP4_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
  reach AS (SELECT DISTINCT a AS node, a AS seen FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen),
  lowest AS (SELECT node, min(seen) AS low FROM reach GROUP BY 1), degree AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
  SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id, coalesce(low, vec_id) = vec_id AS kept
  FROM embeddings LEFT JOIN lowest ON node = vec_id LEFT JOIN degree ON a = vec_id"""

OP5_SQL = f"""WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings WHERE {_FINITE}),
  s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
  SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_REST = "regexp_extract({u}, '(?s)^.*?://(.*)$', 1)"
_HOST = "translate(regexp_extract({r}, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({r}, '(?s)^[^/?#]*([^?#]*)', 1)"
_QUERY = "regexp_extract({r}, '(?s)^[^?#]*(\\?[^#]*)?', 1)"


def _part(part: str, url: str) -> str:
    return f"coalesce({part.format(r=_REST.format(u=url))}, '')"


def _node(url: str) -> str:
    return f"CASE WHEN {_part(_HOST, url)} <> '' THEN {_part(_HOST, url)} || {_part(_PATH, url)} || {_part(_QUERY, url)} END"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _groups(pattern: str, n: int) -> str:
    """Whichever of a pattern's groups matched."""
    return " || ".join(f"regexp_extract(tag, {_quoted(pattern)}, {k})" for k in range(1, n + 1))


_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)

OP9_SQL = f"""WITH RECURSIVE p AS (SELECT page_id, url, html, {_part(_HOST, 'url')} AS host, {_part(_PATH, 'url')} AS path, {_node('url')} AS node FROM pages),
  tags AS (SELECT url, host, path, node, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM p),
  named AS (SELECT *, replace(trim(CASE WHEN regexp_matches(tag, {_quoted(url_filter._CANONICAL)}) THEN {_groups(url_filter._HREF, 3)}
    WHEN regexp_matches(tag, {_quoted(url_filter._REFRESH)}) THEN {_groups(url_filter._TARGET, 2)} END, ' '), '&amp;', '&') AS t FROM tags),
  absolute AS (SELECT node, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN t LIKE '//%' THEN 'x:' || t WHEN t LIKE '/%' THEN 'x://' || host || t WHEN t LIKE '?%' THEN 'x://' || host || path || t WHEN t LIKE '#%' THEN url
    ELSE 'x://' || host || CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END || t END AS target FROM named WHERE t <> ''),
  arcs AS (SELECT node AS a, {_node('target')} AS b FROM absolute), links AS (SELECT a, b FROM arcs WHERE a <> b UNION SELECT b, a FROM arcs WHERE a <> b),
  reach AS (SELECT DISTINCT a AS node, a AS seen FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen),
  places AS (SELECT DISTINCT node, {_part(_HOST, "'x://' || node")} AS host, {_part(_PATH, "'x://' || node")} AS path FROM (SELECT node FROM p UNION SELECT node FROM reach) WHERE node IS NOT NULL),
  rules AS (SELECT v AS verdict, h, f, h || f AS rule FROM (VALUES {_RULES}) x(v, h, f)),
  fit AS (SELECT node, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM places JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, f) GROUP BY 1),
  inherited AS (SELECT reach.node, coalesce(bool_or(fit.verdict = 'block'), false) AND NOT coalesce(bool_or(fit.verdict = 'allow'), false) AS blocked FROM reach LEFT JOIN fit ON fit.node = seen GROUP BY 1)
  SELECT page_id, p.host, p.path, rule, coalesce(fit.verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
  FROM p LEFT JOIN fit ON fit.node = p.node LEFT JOIN inherited ON inherited.node = p.node"""

OP10_SQL = """WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
  win AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k FROM w, unnest(range(1, len(words) - 11)) t(i)),
  low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY 1),
  gone AS (SELECT DISTINCT doc_id, i + o AS p FROM win JOIN low USING (k), range(13) r(o) WHERE m < doc_id),
  g AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY 1)
  SELECT doc_id, len(words) AS n_words, coalesce(len(ps), 0) AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' ')) AS kept_sha256 FROM w LEFT JOIN g USING (doc_id)"""


_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(regexp_replace(" + _LOWER + ", '[!-/:-@\\[-`{{-~]', '', 'g'), '[^\\x20\\x09-\\x0D]+')"
_TEMPLATES = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licenses.TEMPLATES.items())

OP3_SQL = f"""WITH t AS (SELECT license, {_WORDS.format(t='body')} AS words FROM (VALUES {_TEMPLATES}) x(license, body)),
  wanted AS (SELECT DISTINCT license, array_to_string(words[i:i + 4], ' ') AS s FROM t, unnest(range(1, len(words) - 3)) r(i)),
  sized AS (SELECT *, count(*) OVER (PARTITION BY license) AS n FROM wanted),
  d AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS.format(t='text')} AS words FROM documents WHERE text IS NOT NULL),
  shingles AS (SELECT row_id, doc_id, i, array_to_string(words[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(words) - 3)) r(i)),
  seen AS (SELECT row_id, doc_id, i, s, license, n FROM shingles JOIN sized USING (s)),
  runs AS (SELECT a.row_id, a.doc_id, a.license, a.i, CAST(count(DISTINCT b.s) AS DOUBLE) / a.n AS containment, max(b.i) AS last FROM seen a
  JOIN seen b ON a.row_id = b.row_id AND a.license = b.license AND b.i >= a.i AND b.i < a.i + 2 * a.n GROUP BY a.row_id, a.doc_id, a.license, a.i, a.n)
  SELECT doc_id, license, containment, i - 1 AS first_word, last + 4 AS end_word FROM runs WHERE containment >= {licenses.CONTAINMENT}
  QUALIFY row_number() OVER (PARTITION BY row_id, license ORDER BY containment DESC, i, last) = 1"""


#: crc32 by its table, which SQL makes from the polynomial; words meet where one letter taken out leaves the same.
OP11_SQL = f"""WITH RECURSIVE crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS entry FROM range(256) r(i)),
  runs AS (SELECT doc_id, {{lower}} AS t FROM documents),
  each AS (SELECT doc_id, unnest(regexp_extract_all(t, '[a-z\u00C0-\u00FF]+')) AS run FROM runs),
  counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS k, run, count(*) AS c FROM each WHERE length(run) >= 6 GROUP BY 1, 2),
  spelled AS (SELECT run, c, hex(encode(k)) AS x FROM counted),
  hashed AS (SELECT run, c, xor(4294967295, list_reduce(list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
    lambda h, b: xor(h >> 8, entry[xor(h & 255, b) + 1]), 4294967295)) AS h FROM spelled, crc),
  slipped AS (SELECT c, CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
  words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY 1 HAVING sum(c) >= 5),
  holes AS (SELECT DISTINCT word, n, i, word[:i] || '_' || word[i + 2:] AS left_over, word[:i] || word[i + 2:] AS shorter FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
  pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (left_over) WHERE a.word <> b.word
    UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.shorter UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.shorter),
  best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM pairs GROUP BY 1),
  formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * w.n THEN top END AS form_n,
    CASE WHEN top >= 5 * w.n THEN (SELECT min(p.other) FROM pairs p WHERE p.word = w.word AND p.other_n = top) END AS form FROM words w LEFT JOIN best b ON b.word = w.word),
  walk AS (SELECT word, form AS up FROM formed WHERE form IS NOT NULL UNION SELECT walk.word, f.form FROM walk JOIN formed f ON f.word = walk.up WHERE f.form IS NOT NULL),
  ends AS (SELECT walk.word, walk.up AS root FROM walk JOIN formed f ON f.word = walk.up WHERE f.form IS NULL)
  SELECT f.word, f.form, coalesce(ends.root, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN ends ON ends.word = f.word"""

OP12_SQL = f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format(t="coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
  sizes AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY 1),
  f AS (SELECT lang, m, p, count(*) AS a FROM (SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: words[i:i + m - 1])) AS p FROM w, range(1, 6) r(m)) GROUP BY 1, 2, 3 HAVING count(*) >= 100),
  covered AS (SELECT DISTINCT lang, p[i:i + m - 2] AS p, a FROM f, (VALUES (1), (2)) v(i) WHERE m > 2),
  own AS (SELECT * FROM f WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM covered c WHERE c.lang = f.lang AND c.p = f.p AND c.a = f.a)),
  cuts AS (SELECT o.lang, o.p, o.a, k, x.a AS l, y.a AS r, n, (1000::HUGEINT * o.a * n) // (x.a::HUGEINT * y.a) AS score FROM own o, range(1, 5) t(k)
    JOIN f x ON x.lang = o.lang AND x.p = o.p[:k] JOIN f y ON y.lang = o.lang AND y.p = o.p[k + 1:] JOIN sizes s ON s.lang = o.lang WHERE k < o.m),
  weakest AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM weakest
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000"""

OP13_SQL = """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
  FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


def oracle_sql() -> dict[str, str]:
    """What SQL can say: the rest learns a model, tokenizes or needs XXH64, and is tested by brute force."""
    return {"op3_license_scan": OP3_SQL, "op4_embedding_near_dedup": OP4_SQL, "op5_exact_top_k": OP5_SQL, "op9_url_filters": OP9_SQL, "op10_substring_dedup": OP10_SQL, "op11_spelling_variants": OP11_SQL.replace("{lower}", _LOWER.format(t="text")), "op12_phrase_collocations": OP12_SQL, "op13_exact_dedup": OP13_SQL}
