"""The operators applied to their whole tables, and the SQL each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.llm import decontamination, embeddings, language, licenses, merkle, pieces, prefix_trie, quality, secret_scan, simhash, suffix_dedup, toxicity, url_filter
from driftline.llm.common import ascii_lower, held_out, table

# Fixed values of the rule set: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


_OP1 = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
), judged AS (
  SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM parts
)
SELECT page_id, host, path,
  CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
  END AS rule,
  CASE
    WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow'
  END AS verdict
FROM judged
"""

def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """Every word of every template votes for the place where the template would begin."""
    rows = []
    for n, t in enumerate(licenses.BASE_TEMPLATES + licenses.NOTICES):
        key = range(t.key_at, t.key_at + len(t.key.split()))
        for at, word in enumerate(t.words):
            rows.append(f"({n}, '{t.label}', {t.base}, {t.least}, {len(t.words)}, {len(key)}, {at}, '{word}', {at in key})")
    return f"""
WITH posting(t, label, base, least, n, n_key, place, word, in_key) AS (VALUES {", ".join(rows)}),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
  FROM documents
), placed AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM texts
), hits AS (
  SELECT r, t, any_value(label) AS label, any_value(base) AS base, pos - place AS start,
    count(*) / any_value(n)::DOUBLE AS cover
  FROM placed JOIN posting USING (word)
  GROUP BY r, t, pos - place
  HAVING count(*) FILTER (in_key) = any_value(n_key) AND count(*) / any_value(n)::DOUBLE >= any_value(least)
), per AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
    max(start) FILTER (base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(cover) AS score
  FROM hits GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0)::DOUBLE AS score
FROM texts LEFT JOIN per USING (r)
"""


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept_back = held_out(F.col("doc_id"), 3, 1)
    model = language.train(language.training_rows(docs.where(~kept_back)))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", kept_back.alias("held_out"), "lang_pred", "score")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_documents(table(spark, sf_dir, "documents"), with_decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[secret_scan.count_kind(F.col("base"), k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.spans_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.spans_text(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter(spans, lambda s: ~s["live"])).cast("long").alias("n_example"),
    )


_ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    "|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
_OP6 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), kinds(k, kind, pattern, part, least) AS (VALUES
  (0, 'assign', '{_ASSIGN}', 2, 6), (1, 'access', 'AKIA[A-Z0-9]{{16,}}', 0, 20),
  (2, 'hex', '[0-9a-f]{{24,}}', 0, 24), (3, 'mixed', '[A-Za-z0-9+/_=-]{{20,}}', 0, 20)
), matched AS (
  SELECT r, doc_id, source, k, kind, least, regexp_extract_all(text, pattern) AS hits,
    string_split_regex(text, pattern) AS gaps,
    CASE WHEN part = 2 THEN regexp_extract_all(text, '{_ASSIGN}', 2) ELSE regexp_extract_all(text, pattern) END AS parts
  FROM texts, kinds WHERE regexp_matches(text, pattern)
), each AS (
  SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM matched
), placed AS (
  SELECT r, doc_id, source, k, kind, parts[i] AS value, length(hits[i]) AS size,
    (list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0))::BIGINT AS start
  FROM each WHERE length(parts[i]) >= least
), kept AS (
  SELECT * FROM placed p WHERE k < 3 OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]')
    AND regexp_matches(value, '[A-Z]') AND NOT EXISTS (SELECT 1 FROM placed b WHERE b.r = p.r AND b.k < 3
      AND b.start < p.start + p.size AND p.start < b.start + b.size))
), owned AS (
  SELECT value, count(DISTINCT source) < {secret_scan.EXAMPLE_OWNERS} AS live FROM kept GROUP BY value
), per AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || start || ':' || start + size, ',' ORDER BY start, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || start || ':' || start + size, ',' ORDER BY start, k) FILTER (k < 3 OR live) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (k < 3 AND NOT live) AS n_example
  FROM kept JOIN owned USING (value) GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM texts LEFT JOIN per USING (r)
"""

_LOWER_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"
)
_OP7 = f"""
WITH items AS (
  SELECT item_id, words, len(words) AS n, least(len(words), {decontamination.SHINGLE_WORDS}) AS size
  FROM (SELECT DISTINCT item_id, {_LOWER_WORDS} AS words FROM benchmark) WHERE len(words) > 0
), places AS (
  SELECT item_id, n, size, q, array_to_string(words[q + 1:q + size], ' ') AS shingle
  FROM (SELECT *, unnest(range(0, n - size + 1)) AS q FROM items)
), weights AS (
  SELECT item_id, sum(length(replace(shingle, ' ', ''))) AS weight
  FROM (SELECT DISTINCT item_id, shingle FROM places) GROUP BY item_id
), docs AS (
  SELECT DISTINCT doc_id, {_LOWER_WORDS} AS words FROM documents
), runs AS (
  SELECT doc_id, len(words) AS n_doc, size, p, array_to_string(words[p + 1:p + size], ' ') AS shingle
  FROM (SELECT doc_id, words, size, unnest(range(0, len(words) - size + 1)) AS p
    FROM docs, (SELECT DISTINCT size FROM items) WHERE len(words) >= size)
), hits AS (
  SELECT doc_id, item_id, n, r.size, p, shingle, greatest(0, least(p - q, n_doc - n)) AS start
  FROM runs r JOIN places USING (shingle, size)
), shared AS (
  SELECT DISTINCT s.doc_id, s.item_id, s.start, h.shingle
  FROM (SELECT DISTINCT doc_id, item_id, n, size, start FROM hits) s
  JOIN hits h ON h.doc_id = s.doc_id AND h.item_id = s.item_id AND h.p BETWEEN s.start AND s.start + s.n - s.size
), scored AS (
  SELECT doc_id, item_id, start, sum(length(replace(shingle, ' ', ''))) / any_value(weight)::DOUBLE AS similarity
  FROM shared JOIN weights USING (item_id) GROUP BY doc_id, item_id, start
)
SELECT doc_id, item_id, start::BIGINT AS start_word, similarity FROM scored
WHERE similarity >= {decontamination.MIN_SIMILARITY}
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "start_word", "similarity")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_held_in(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        "predicted",
        "n_sentences",
        F.size("offending").alias("n_offending"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = merkle.leaf_of([ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in columns])
    found = merkle.manifest(docs, columns, "lang", "doc_id", {"tampered": F.when(chosen, F.unhex(lowered))})
    presented = F.coalesce(F.lower(F.hex("tampered")), F.col("leaf"))
    found = found.withColumn("folded_root", merkle.folded(presented, F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: crc32 of an id's decimal digits: the table from its rule, then one look-up for each digit.
_CRC32 = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({id}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))"""
_CRC_TABLE = """SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
    lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS crc"""


def _framed_sql(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR, '-')"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HEAD = " || ".join(_framed_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))
# Two rounds of one climb: the leaves of each language, then the subroots. Nodes are runs of 8 in order.
_OP11 = f"""
WITH RECURSIVE crcs AS ({_CRC_TABLE}),
leaves AS (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256({_HEAD} || {_framed_sql("text")}) AS leaf,
    CASE WHEN xor({_CRC32.format(id="doc_id")}, 4294967295) % 3 = 0 THEN sha256({_HEAD} || {_framed_sql(_LOWERED)}) END AS tampered
  FROM documents, crcs
), low AS (
  SELECT 0 AS level, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n, leaf AS digest
  FROM leaves
  UNION ALL
  SELECT any_value(level) + 1, lang, idx // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY idx))
  FROM low WHERE n > 1 GROUP BY lang, idx // 8
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS total
  FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, place AS idx, total AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' ORDER BY idx))
  FROM high WHERE n > 1 GROUP BY idx // 8
), low_runs AS (
  SELECT level, lang, idx // 8 AS up, list(digest ORDER BY idx) AS run FROM low WHERE n > 1 GROUP BY ALL
), high_runs AS (
  SELECT level, idx // 8 AS up, list(digest ORDER BY idx) AS run FROM high WHERE n > 1 GROUP BY ALL
), low_walk AS (
  SELECT r, lang, 0 AS level, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    '' AS proof, coalesce(tampered, leaf) AS own
  FROM leaves
  UNION ALL
  SELECT r, w.lang, w.level + 1, idx // 8,
    proof || array_to_string(run[1:idx % 8] || run[idx % 8 + 2:], ''),
    sha256(array_to_string(run[1:idx % 8] || [own] || run[idx % 8 + 2:], ''))
  FROM low_walk w JOIN low_runs u ON u.level = w.level AND u.lang IS NOT DISTINCT FROM w.lang AND u.up = idx // 8
), high_walk AS (
  SELECT r, 0 AS level, place AS idx, proof, own
  FROM low_walk w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang
  WHERE w.level = (SELECT max(level) FROM low l WHERE l.lang IS NOT DISTINCT FROM w.lang)
  UNION ALL
  SELECT r, w.level + 1, idx // 8,
    proof || array_to_string(run[1:idx % 8] || run[idx % 8 + 2:], ''),
    sha256(array_to_string(run[1:idx % 8] || [own] || run[idx % 8 + 2:], ''))
  FROM high_walk w JOIN high_runs u ON u.level = w.level AND u.up = idx // 8
)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = digest AS verified
FROM high_walk w JOIN leaves USING (r) JOIN subroots s ON s.lang IS NOT DISTINCT FROM leaves.lang, high h
WHERE h.n = 1 AND w.level = h.level
"""


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents"))
    model = quality.fit_held_in(measured, table(spark, sf_dir, "labels"))
    scored = quality.score_measured(measured, model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    ident = F.col("conv_id")
    head = F.crc32(ident.cast("string").cast("binary")) % 9
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns, ident - ident % 5, head, 8))


_TURN = "coalesce(octet_length(encode({c})), 0) || ':' || coalesce({c}, '')"
# Prefixes as whole text; subtrees by the path of each node's smallest member.
_OP13 = f"""
WITH crcs AS ({_CRC_TABLE}),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, sha256({_TURN.format(c="role")} || {_TURN.format(c="text")})) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor({_CRC32.format(id="conv_id")}, 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crcs
), heads AS (
  SELECT c.conv_id, o.pos, o.role, o.text
  FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.pos <= c.h
), taken AS (
  SELECT c.conv_id, h, count(d.pos) AS m FROM convs c LEFT JOIN heads d USING (conv_id) GROUP BY c.conv_id, h
), rebuilt AS (
  SELECT conv_id, pos AS depth, role, text FROM heads
  UNION ALL
  SELECT conv_id, m + pos - h, role, text FROM own JOIN taken USING (conv_id) WHERE pos > h
), pathed AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS bytes,
    string_agg(octet_length(encode(role)) || ':' || role || octet_length(encode(text)) || ':' || text, '')
      OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM rebuilt
), members AS (
  SELECT conv_id, 0 AS depth, 0 AS bytes, '' AS path, NULL AS parent FROM convs
  UNION ALL
  SELECT conv_id, depth, bytes, path, lag(path, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) FROM pathed
), nodes AS (
  SELECT path, any_value(depth) AS depth, any_value(parent) AS parent, any_value(bytes) AS bytes,
    min(conv_id) AS conv_id, count(*) AS n_convs
  FROM members GROUP BY path
), kids AS (
  SELECT parent AS path, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), known AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)
), sums AS (
  SELECT m.path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * n.bytes) AS saved
  FROM known n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.path
), ends AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, path FROM members QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM known n JOIN sums USING (path) LEFT JOIN ends USING (path) LEFT JOIN nodes p ON p.path = n.parent
"""


#: Name: (query, SQL or None).
QUERIES = {
    "op1_url_filter": (op1_url_filter, _OP1),
    "op2_license_scan": (op2_license_scan, _license_sql()),
    "op3_suffix_dedup": (op3_suffix_dedup, None),
    "op4_language_id": (op4_language_id, None),
    "op5_sentencepiece": (op5_sentencepiece, None),
    "op6_secret_scan": (op6_secret_scan, _OP6),
    "op7_decontamination": (op7_decontamination, _OP7),
    "op8_embedding_dedup": (op8_embedding_dedup, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_simhash_dedup": (op10_simhash_dedup, None),
    "op11_merkle_manifest": (op11_merkle_manifest, _OP11),
    "op12_quality": (op12_quality, None),
    "op13_prefix_trie": (op13_prefix_trie, _OP13),
}
