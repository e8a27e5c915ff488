"""The operators over the tables of a data folder, and their SQL where SQL can tell the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import chat, decontam, fim, jaccard, langid, lengths, lm, mixing, negatives, quality, secrets, sst, urls
from kerbline.llm.common import new_folder, table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digest(chat.format_turns(turns))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given labels are those of documents; pages have none, so the label of the document of a page's number stands
    for it.  A page is bad where that label has low quality or is toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    outcomes = pages.join(labels, "page_id").select(urls.host_of(F.col("url")).alias("host"), "bad")
    return urls.judge(pages, outcomes)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.train(secrets.label_samples(docs))))


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sst.read(sst.write(table(spark, sf_dir, "documents"), new_folder(spark, "shards")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_left")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.amounts(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.histogram(lengths.encoded_lengths(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.judge(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_benchmark_decontamination, op2_chat_formatting, op3_url_filter, op4_secret_scan, op5_token_shards, op6_quality_rules, op7_source_mixing, op8_ngram_jaccard_join, op9_lm_scoring, op10_token_counts, op11_hard_negatives, op12_language_id, op13_fill_in_middle, pipeline)}

SQL: dict[str, str] = {}

SQL["op2_chat_formatting"] = r"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
 UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok'),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) AS k,
 length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t')) + length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c')) + 14 AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(sum(chars) AS BIGINT) AS formatted_chars FROM numbered GROUP BY conv_id"""

_LAST = lambda n: f"array_to_string(list_slice(string_split(name, '.'), -{n}, -1), '.')"
_TWO = f"{_LAST(2)} IN ({', '.join(repr(x) for x in urls.SUFFIXES)})"
_SUFFIX, _DOMAIN = f"CASE WHEN {_TWO} THEN {_LAST(2)} ELSE {_LAST(1)} END", f"CASE WHEN {_TWO} THEN {_LAST(3)} ELSE {_LAST(2)} END"
_LEVELS = [("suffix", _SUFFIX, "''", "root"), ("domain", _DOMAIN, _SUFFIX, "suffix"), ("host", "name", _DOMAIN, "domain")]


def _url_sql() -> str:
    host = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    parts = [
        f"seen AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM (SELECT page_id, {host} AS host, {path} AS path FROM pages))",
        "bad AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id)",
        "hosts AS (SELECT name, count(*) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM seen JOIN bad USING (page_id) GROUP BY name)",
        "root AS (SELECT '' AS name, coalesce(sum(bad), 0) + 1.0E0 AS a, coalesce(sum(n), 0) - coalesce(sum(bad), 0) + 1.0E0 AS b FROM hosts)",
    ]
    for level, key, above, parent in _LEVELS:
        parts += [
            f"{level}_n AS (SELECT h.*, p.a AS pa, p.b AS pb, p.a / (p.a + p.b) AS mean FROM (SELECT key AS name, above, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM (SELECT {key} AS key, {above} AS above, n, bad FROM hosts) GROUP BY key, above) h JOIN {parent} p ON h.above = p.name)",
            f"{level}_fit AS (SELECT round((sum(n * pow(bad * 1.0E0 / n - mean, 2)) - sum(mean * (1 - mean))) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 6) AS rho FROM {level}_n)",
            f"{level}_s AS (SELECT CASE WHEN rho IS NULL OR rho <= 1 / 1001.0E0 THEN 1000.0E0 ELSE greatest(2.0E0, 1 / rho - 1) END AS strength FROM {level}_fit)",
            f"{level} AS (SELECT name, (pa - bad) / (pa + pb - n) * least(strength, pa + pb - n) + bad AS a, (1 - (pa - bad) / (pa + pb - n)) * least(strength, pa + pb - n) + n - bad AS b FROM {level}_n, {level}_s)",
        ]
    ab = ", ".join(f"coalesce(h.{x}, d.{x}, s.{x}, r.{x}) AS {x}" for x in "ab")
    parts.append(f"judged AS (SELECT k.*, {ab} FROM (SELECT *, {_DOMAIN} AS of_domain, {_SUFFIX} AS of_suffix FROM seen) k LEFT JOIN host h ON k.name = h.name LEFT JOIN domain d ON of_domain = d.name LEFT JOIN suffix s ON of_suffix = s.name, root r)")
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    ordered = sorted(urls.RULES, key=lambda r: (-len(r[1]) - len(r[2]), r))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ordered) + f" WHEN bad_bound > {urls.LIMIT} THEN 'block' ELSE 'allow' END"
    bound = f"round(a / (a + b) - {urls.Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)), 6)"
    return f"WITH {', '.join(parts)} SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict, bad_bound FROM (SELECT *, {bound} AS bad_bound FROM judged)"


SQL["op3_url_filter"] = _url_sql()

_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'"
SQL["op6_quality_rules"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, source, text, coalesce(text, '') AS t FROM documents),
words AS (SELECT k, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w, generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM docs),
wins AS (SELECT k, i, w, lead(w, 1) OVER p AS w1, lead(w, 2) OVER p AS w2, lead(w, 3) OVER p AS w3, lead(w, 4) OVER p AS w4, lead(w, 5) OVER p AS w5, lead(w, 6) OVER p AS w6, lead(w, 7) OVER p AS w7 FROM words WINDOW p AS (PARTITION BY k ORDER BY i)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w, w1, w2, w3, w4, w5, w6, w7) AS c FROM wins WHERE w7 IS NOT NULL) WHERE c > 1),
repeats AS (SELECT k, count(*) AS n FROM (SELECT k, i, max(j) OVER (PARTITION BY k ORDER BY i) AS j FROM (SELECT w.k, w.i, t.i AS j FROM words w LEFT JOIN twice t ON w.k = t.k AND w.i = t.i)) WHERE j > i - 8 GROUP BY k),
lines AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM docs),
dups AS (SELECT k, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
base AS (SELECT d.*, coalesce(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')), 0) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(u.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM docs d LEFT JOIN dups u ON d.k = u.k LEFT JOIN repeats r ON d.k = r.k),
texts AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL), sizes AS (SELECT source, count(*) AS host_docs FROM texts GROUP BY source),
held AS (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM texts), normal AS (SELECT source, text, regexp_replace(translate(line, {_ASCII}), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM held),
frequent AS (SELECT n.source, n.line FROM (SELECT source, line, count(DISTINCT text) AS c FROM normal WHERE line <> '' GROUP BY source, line) n JOIN sizes s ON n.source IS NOT DISTINCT FROM s.source WHERE c > {quality.MIN_DOCS} AND c > greatest({quality.MIN_DOCS}, host_docs * {quality.SHARE})),
lost AS (SELECT l.k, CAST(sum(len(regexp_extract_all(l.line, '[^\x20\x09-\x0D]+'))) AS BIGINT) AS n FROM (SELECT d.k, d.source, unnest(string_split(text, chr(10))) AS line FROM docs d WHERE text IS NOT NULL) l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND regexp_replace(translate(l.line, {_ASCII}), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') = f.line GROUP BY l.k),
last AS (SELECT b.*, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed, n_words - coalesce(x.n, 0) AS words_left FROM base b LEFT JOIN lost x ON b.k = x.k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND words_left >= n_words * {quality.LEAST_LEFT} AS kept, words_left FROM last"""

_MARKS = " + ".join(f"length(t) - length(replace(t, '{x}', ''))" for x in mixing.SYMBOLS)
SQL["op7_source_mixing"] = rf"""
WITH docs AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, coalesce(text, '') AS t FROM documents),
keyed AS (SELECT doc_id, source, size, -ln((CAST('0x' || substr(md5(concat('0:', coalesce(CAST(doc_id AS VARCHAR), 'null'))), 1, 13) AS BIGINT) + 1.0E0) / {2**52}.0E0) / (1.0E0 / (1.0E0 + 50.0E0 * ({_MARKS}) / greatest(length(t), 1))) AS key FROM docs),
ranked AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM keyed GROUP BY source),
capped AS (SELECT *, [5.0E0, 2.0E0, 1.0E0][(rank - 1) % 3 + 1] AS w, CAST(source_size * 3 AS DOUBLE) AS cap FROM ranked),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0E0)) / sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM capped),
fixed AS (SELECT arg_min(level, struct_pack(a := cap / w, b := rank)) AS level FROM levels WHERE level * w <= cap),
goal AS (SELECT source, source_size, CASE WHEN f.level IS NULL THEN cap ELSE least(f.level * w, cap) END AS target FROM levels l, fixed f),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs, CAST(floor(target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size) AS BIGINT) AS rest FROM goal),
cum AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.rest, count(*) OVER same AS m, CAST(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS FIRST, size) AS BIGINT) AS upto FROM keyed k JOIN epochs e ON k.source IS NOT DISTINCT FROM e.source WINDOW same AS (PARTITION BY k.source, key, doc_id, size))
SELECT doc_id, size, source_size, target, epochs * size + CASE WHEN upto <= rest THEN size WHEN upto - size * m <= rest THEN (rest - upto + size * m) // m ELSE 0 END AS taken FROM cum"""

SQL["op13_fill_in_middle"] = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
cut AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines, [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN [0, 1, 2, 3]] AS hs FROM docs),
drawn AS (SELECT *, len(lines) AS n, least(hs[1] % (len(lines) + 1), hs[2] % (len(lines) + 1)) AS lo, greatest(hs[1] % (len(lines) + 1), hs[2] % (len(lines) + 1)) AS hi,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR hs[3] % 100 >= 100 THEN 'plain' WHEN hs[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(lines[1:lo], '') AS p, array_to_string(lines[lo + 1:hi], '') AS m, array_to_string(lines[hi + 1:n], '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts"""

SQL["op11_hard_negatives"] = """
WITH fine AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS q FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score FROM fine a JOIN fine r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
told AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
near AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS k FROM told p JOIN scores s ON p.anchor_id = s.anchor_id
 WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM near WHERE k <= 3"""
