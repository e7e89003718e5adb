"""The registered queries of this subpackage, and the SQL that returns the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import conversation_trie, fill_in_middle, license_scan, packing, quality_rules, secret_scan, sharding, token_counts, url_filter
from tapeloom.llm.common import written
from tapeloom.llm.decontamination import contaminations
from tapeloom.llm.embedding_dedup import near_vectors
from tapeloom.llm.near_dedup import near_duplicates
from tapeloom.llm.toxicity import scored, train

#: A public vocabulary file on every machine; a parameter of op4.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.judged(quality_rules.ledger(_table(spark, sf_dir, "documents")), "v1")
    base_failed = F.col("fail_bits").bitwiseAND(F.lit(quality_rules.mask(quality_rules.POLICIES["base"])).cast("long")) != 0
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), "kept", "fail_bits")


def op2_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), packing.word_count(F.col("text")))


def op3_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(_table(spark, sf_dir, "documents"), shards=24)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), token_counts.sentencepiece_pieces(VOCABULARY))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judged(_table(spark, sf_dir, "pages"), model)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ledger = secret_scan.new_ledger(spark)
    # Two deliveries: the blobs whose address begins with a digit below 8, then all documents, of which the ledger has half by then.
    secret_scan.scan(docs.filter(secret_scan.address_of(F.col("text")) < "8"), ledger)
    return secret_scan.report(secret_scan.findings(docs, ledger))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return scored(docs, train(docs, _table(spark, sf_dir, "labels")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = written(conversation_trie.ordered(_table(spark, sf_dir, "conversations")), "turns")
    turns, members = conversation_trie.rebuilt(given)
    nodes, endings = conversation_trie.prefix_trie(turns, members)
    ends = conversation_trie.ends_sha256(endings).withColumnRenamed("node", "ended")
    nothing = F.sha2(F.lit(b""), 256)
    return nodes.join(ends, F.col("node") == F.col("ended"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256")
    )


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.report(fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents")))


_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(text=_LOWER.format(text="text"))} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * x >= 80 * (p.n + q.n - x)
), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (
  SELECT a AS v, a AS t FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.t = e.a
), m AS (SELECT v, min(t) AS root FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.root, d.doc_id) AS component_id, coalesce(m.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.v = d.doc_id
"""

OP1_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format(text="text")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, w FROM w WHERE len(w) >= 5
), k AS (SELECT doc_id, p, array_to_string(w[p:p+4], ' ') AS k FROM g
), r AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM k) WHERE n > 1
), c AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS i FROM r) GROUP BY 1
), m AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '\p{{L}}')) AS n_letters
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id
), b AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END + CASE WHEN 2 * n_upper > n_letters THEN 16 ELSE 0 END
    + CASE WHEN 2 * word_chars < 5 * n_words OR word_chars > 15 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b
"""


def _sql_pattern(pattern: str) -> str:
    """The patterns of secret_scan for RE2: letters in either case spelt out where the pattern asks for it."""
    if pattern.startswith("(?i)"):
        names, rest = pattern[4:].split(")", 1)
        pattern = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names) + ")" + rest
    return pattern.replace("'", "''")


def _secret_sql() -> str:
    kinds, unions = [], []
    for i, (_, pattern, group, least) in enumerate(secret_scan.RULES):
        p = _sql_pattern(pattern if pattern != "[0-9a-f]+" else f"[0-9a-f]{{{least},}}")
        kinds.append(
            f"k{i} AS (SELECT doc_id, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {group}) AS g, string_split_regex(t, '{p}') AS s FROM d WHERE regexp_matches(t, '{p}')), "
            f"s{i} AS (SELECT doc_id, {i} AS kind, m[j] AS m, coalesce(list_sum(list_transform(s[1:j], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:j-1], lambda x: length(x))), 0) AS a "
            f"FROM (SELECT *, unnest(range(1, len(m) + 1)) AS j FROM k{i}) WHERE length(g[j]) >= {least})"
        )
        unions.append(f"SELECT * FROM s{i}")
    names = "[" + ", ".join(f"'{r[0]}'" for r in secret_scan.RULES) + "]"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {", ".join(kinds)},
a AS ({" UNION ALL ".join(unions)}),
x AS (SELECT doc_id, kind, a, {names}[kind + 1] || ':' || a::BIGINT || ':' || (a + length(m))::BIGINT AS span FROM a),
y AS (SELECT doc_id, sum((kind = 0)::INT)::BIGINT AS n_assign, sum((kind = 1)::INT)::BIGINT AS n_access, sum((kind = 2)::INT)::BIGINT AS n_hex,
      coalesce(string_agg(span, ',' ORDER BY a, kind) FILTER (kind < 3), '') AS base, string_agg(span, ',' ORDER BY a, kind) AS spans FROM x GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN y ON y.doc_id = d.doc_id
"""


def _license_sql(threshold: float = 0.8) -> str:
    phrases = ", ".join(f"('{p}', '{x}')" for p, x in license_scan.PHRASES)
    plain = [(i, label, *license_scan.parsed(t, threshold)) for i, (label, t) in enumerate(license_scan.TEMPLATES)]
    templates = ", ".join(f"({i}, '{label}', {own}, {least}, {block})" for i, label, own, least, block in plain)
    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format(text="coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), p(phrase, label) AS (VALUES {phrases}), q AS (SELECT string_split(phrase, ' ') AS q, label FROM p
), b AS (
  SELECT doc_id, label, i - 1 AS place FROM (SELECT doc_id, w, q, label, unnest(range(1, len(w) + 1)) AS i FROM w, q) WHERE w[i:i+len(q)-1] = q
), m(id, label, tokens, least, block) AS (VALUES {templates}), d AS (SELECT doc_id, w, list_distinct(w) AS u FROM w
), g AS (SELECT doc_id, w, id, label, tokens, least, block FROM d, m WHERE len(list_intersect(u, tokens)) >= least
), c AS (
  SELECT doc_id, id, any_value(label) AS label, max(len(list_intersect(w[i:i+block-1], tokens))) AS o, any_value(least) AS least, any_value(len(tokens)) AS n
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM g) GROUP BY doc_id, id
), f AS (SELECT doc_id, label, o / n AS score FROM c WHERE o >= least
), y AS (SELECT doc_id, count(*)::BIGINT AS n_base, min(place)::BIGINT AS first_word, max(place)::BIGINT AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY 1
), z AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM f) GROUP BY 1
), s AS (SELECT doc_id, max(score) AS score FROM f GROUP BY 1)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0)::DOUBLE END AS score
FROM w LEFT JOIN y USING (doc_id) LEFT JOIN z USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP11_SQL = """
WITH o AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS r
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), i AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS donor, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda j: ascii(substr(conv_id::VARCHAR, j, 1))::BIGINT) AS bytes FROM o
), c AS (
  SELECT conv_id, donor, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295::BIGINT) % 6 AS h FROM i
), m AS (SELECT c.conv_id, h, donor, count(o.r) AS m FROM c LEFT JOIN o ON o.conv_id = c.donor AND o.r <= c.h GROUP BY ALL
), b AS (
  SELECT m.conv_id, o.r AS depth, role, text FROM m JOIN o ON o.conv_id = m.donor AND o.r <= m.h
  UNION ALL SELECT m.conv_id, o.r - m.h + m.m, role, text FROM m JOIN o ON o.conv_id = m.conv_id AND o.r > m.h
), k AS (
  SELECT conv_id, depth, length(text) AS chars, md5(string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM b
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM c
), n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM k GROUP BY ALL
), p AS (SELECT n.*, q.node AS parent FROM n LEFT JOIN k q ON q.conv_id = n.conv_id AND q.depth = n.depth - 1
), f AS (SELECT p.*, coalesce(x.n_children, 0) AS n_children FROM p LEFT JOIN (SELECT parent, count(*) AS n_children FROM p WHERE parent IS NOT NULL GROUP BY 1) x ON x.parent = p.node
), s AS (
  SELECT k.node, sum(CASE WHEN f.conv_id IS NOT NULL AND f.n_children = 0 THEN 1 ELSE 0 END) OVER w AS leaves, sum(coalesce((f.n_convs - 1) * f.chars, 0)) OVER w AS saved, k.conv_id, k.depth = max(k.depth) OVER (PARTITION BY k.conv_id) AS ends
  FROM k LEFT JOIN f ON f.node = k.node AND f.conv_id = k.conv_id WINDOW w AS (PARTITION BY k.conv_id ORDER BY k.depth DESC)
), t AS (SELECT node, sum(leaves)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM s GROUP BY 1)
SELECT f.conv_id, f.depth, g.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, ends_sha256
FROM f JOIN t ON t.node = f.node LEFT JOIN n g ON g.node = f.parent
"""

OP12_SQL = """
WITH RECURSIVE d AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), u AS (SELECT row_number() OVER () AS i, vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM d WHERE list_inner_product(v, v) > 0
), l AS (
  SELECT a.i AS i, a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.i <> b.i AND len(a.v) = len(b.v) WHERE list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.9
), e AS (SELECT DISTINCT a, b FROM l
), r AS (
  SELECT a AS v, a AS t FROM e UNION SELECT r.v, e.b FROM r JOIN e ON r.t = e.a
), m AS (SELECT v, min(t) AS root FROM r GROUP BY 1
), n AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT x.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(m.root, x.vec_id) AS component_id, coalesce(coalesce(m.root, x.vec_id) = x.vec_id, true) AS kept
FROM embeddings x LEFT JOIN n ON n.a = x.vec_id LEFT JOIN m ON m.v = x.vec_id
"""

OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), n AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d
), f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM n
), o AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM o
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_length_buckets,
        op3_bounded_ring,
        op4_token_counts,
        op5_url_filter,
        op6_benchmark_decontamination,
        op7_secret_scan,
        op8_minhash_near_dedup,
        op9_license_scan,
        op10_toxicity,
        op11_prefix_trie,
        op12_embedding_near_dedup,
        op13_fill_in_middle,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op7_secret_scan": _secret_sql(),
    "op8_minhash_near_dedup": OP8_SQL,
    "op9_license_scan": _license_sql(),
    "op11_prefix_trie": OP11_SQL,
    "op12_embedding_near_dedup": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
