"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.readers import literal_table
from . import bpe, chat, filteraudit, imatch, merkle, mixing, ngram, quality, sharding, simhash, tokencount, toxicity, urlfilter
from .common import table


def op1_imatch(spark, sf_dir):
    return imatch.edited_likeness(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(docs, path, pattern, keep_text=False)
    return bpe.digests(bpe.decode_documents(encoded, path, pattern)).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "char_distance", "word_distance", "kept")


def op4_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op5_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, 8).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op6_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"  # control strings of other formats inside texts
    more = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)],
                                 "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_conversations(rows.unionByName(more)))


def op7_edit_counts(spark, sf_dir):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_with_edits(docs, tokencount.usual_edits(F.col("text")), path, pattern).select(
        "doc_id", "n_tokens", "n_pretokens", "edited_tokens", "edited_chars", "reencoded")


def op8_ngram_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram.score_documents(docs, ngram.train(docs))


def op9_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.toxicity(docs, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted",
        F.size("passages").cast("long").alias("n_passages"))


#: The contract's rules, and words that mark a host whose pages are listed (fixed values).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
LISTED_HOSTS = r"(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)"


def op11_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = literal_table(spark, URL_RULES, "host string, path string, verdict string")
    listed = pages.where(urlfilter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return urlfilter.filter_urls(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict", "canonical")


def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                      F.translate("text", urlfilter.UPPER, urlfilter.LOWER))
    return merkle.proofs_after_edits(docs, tampered)


def op13_filter_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filteraudit.filter_audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         coalesce(text, '') AS t
  FROM documents),
w AS (
  SELECT *, CASE WHEN length(t) / greatest(size, 1) BETWEEN 3 AND 12 THEN 1.0 ELSE 0.5 END
          * CASE WHEN size >= 20 THEN 1.0 ELSE 0.5 END AS q,
         md5('20240607:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || t) AS h
  FROM d),
k AS (
  SELECT *, -ln((CAST(('0x' || substr(h, 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE) / q::DOUBLE AS key
  FROM w),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, 2 * source_size AS cap, 2 * source_size / weight AS ratio,
         1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(weight) OVER () AS all_weight
  FROM s),
g AS (
  SELECT *, (budget - coalesce(sum(cap) OVER o, 0)) / (all_weight - coalesce(sum(weight) OVER o, 0)) AS level
  FROM f WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce(weight * max(CASE WHEN level <= ratio THEN level END) OVER (), cap::DOUBLE)) AS target
  FROM g),
p AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 1 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN epochs < 2 AND source_size > 0
                    AND before + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""

_OP1_SAMPLED = "['g', 'g', 'g', 'g'" + "".join(f", '{1 << (16 - k):04x}'" for k in range(1, 16)) + "]"
_OP1_TAKEN = "['g', '8', '4'" + ", '2'" * 16 + "]"


def _op1_print(name: str, source: str) -> str:
    return f"""
{name}_t AS (
  SELECT id, t, sha256(t) AS h, t NOT IN (SELECT t FROM frequent) AS inside FROM (SELECT id, unnest(own) AS t FROM {source})),
{name}_k AS (
  SELECT id, list({{'t': t, 'h': h}} ORDER BY t) AS kept
  FROM (SELECT *, bool_or(inside) OVER (PARTITION BY id) AS any_inside FROM {name}_t) WHERE inside OR NOT any_inside GROUP BY id),
{name}_s AS (SELECT *, least(CAST(floor(log2(len(kept))) AS INT), 16) AS scale FROM {name}_k),
{name}_j AS (
  SELECT id, any_value(scale) AS scale, string_agg(CASE WHEN j = '' THEN '' ELSE substr(md5(j), 1, 4) END, '-' ORDER BY i) AS hashes
  FROM (SELECT id, scale, i, array_to_string(list_transform(list_filter(kept, lambda x:
          substr(md5(x.t), 1, 4) < ({_OP1_SAMPLED})[CAST(scale + i // 32 + 1 AS INT)]
          AND substr(x.h, CAST(i % 32 + 1 AS INT), 1) < ({_OP1_TAKEN})[CAST(scale + i // 32 + 1 AS INT)]), lambda x: x.t), ' ') AS j
        FROM (SELECT *, unnest(range(0, 96)) AS i FROM {name}_s)) GROUP BY id),
{name} AS (
  SELECT id, CASE WHEN hashes IS NULL THEN 'none' ELSE scale || ':' || hashes END AS fp FROM {source} LEFT JOIN {name}_j USING (id))"""


_OP1_TERMS = "list_distinct(list_filter(string_split(replace(lower({}), chr(10), ' '), ' '), lambda x: x <> ''))"
OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS id FROM documents),
e AS (
  SELECT id, doc_id, text, coalesce(lead(text) OVER (ORDER BY id), first_value(text) OVER (ORDER BY id)) AS nxt,
         coalesce(lead(id) OVER (ORDER BY id), 1) AS next_id FROM d),
f AS (
  SELECT *, substr(text, 1, CAST(length(text) - length(text) // 2 AS INT))
            || substr(nxt, 1, CAST(length(text) // 2 AS INT)) AS edited FROM e),
o AS (SELECT id, {_OP1_TERMS.format("text")} AS own FROM f),
p AS (SELECT id, {_OP1_TERMS.format("edited")} AS own FROM f),
frequent AS (
  SELECT t FROM (SELECT unnest(own) AS t FROM o) GROUP BY t HAVING count(*) > 0.25::DOUBLE * (SELECT count(*) FROM d)),
{_op1_print("a", "o")},
{_op1_print("b", "p")},
n AS (
  SELECT f.doc_id, CAST(length(f.text) AS BIGINT) AS n_chars, sha256(f.edited) AS edited_sha256, a.fp AS fingerprint,
         b.fp AS edited_fingerprint, c.fp AS next_fingerprint
  FROM f JOIN a USING (id) JOIN b USING (id) JOIN a AS c ON c.id = f.next_id),
u AS (
  SELECT *, CAST(string_split(fingerprint, ':')[1] AS VARCHAR) AS sx, string_split(edited_fingerprint, ':')[1] AS sy,
         string_split(next_fingerprint, ':')[1] AS sz, string_split(string_split(fingerprint, ':')[2], '-') AS x,
         string_split(string_split(edited_fingerprint, ':')[2], '-') AS y, string_split(string_split(next_fingerprint, ':')[2], '-') AS z FROM n),
v AS (
  SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint, x, y, z,
         TRY_CAST(sy AS INT) - TRY_CAST(sx AS INT) AS oy, TRY_CAST(sz AS INT) - TRY_CAST(sx AS INT) AS oz FROM u),
q AS (SELECT unnest(range(0, 96)) AS p),
m AS (
  SELECT doc_id, any_value(n_chars) AS n_chars, any_value(edited_sha256) AS edited_sha256,
         any_value(fingerprint) AS fingerprint, any_value(edited_fingerprint) AS edited_fingerprint,
         any_value(next_fingerprint) AS next_fingerprint,
         -- place p of x is place p - 32 * offset of the other, if it has that scale
         sum(CASE WHEN p - 32 * oy BETWEEN 0 AND 95 AND (x[p + 1] <> '' OR y[CAST(p - 32 * oy + 1 AS INT)] <> '') THEN 1 ELSE 0 END) AS hy,
         sum(CASE WHEN p - 32 * oy BETWEEN 0 AND 95 AND x[p + 1] <> '' AND x[p + 1] = y[CAST(p - 32 * oy + 1 AS INT)] THEN 1 ELSE 0 END) AS sy,
         sum(CASE WHEN p - 32 * oz BETWEEN 0 AND 95 AND (x[p + 1] <> '' OR z[CAST(p - 32 * oz + 1 AS INT)] <> '') THEN 1 ELSE 0 END) AS hz,
         sum(CASE WHEN p - 32 * oz BETWEEN 0 AND 95 AND x[p + 1] <> '' AND x[p + 1] = z[CAST(p - 32 * oz + 1 AS INT)] THEN 1 ELSE 0 END) AS sz
  FROM v, q GROUP BY doc_id)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
       CASE WHEN fingerprint = edited_fingerprint THEN 1.0::DOUBLE WHEN hy = 0 THEN 0.0::DOUBLE ELSE sy::DOUBLE / hy END AS near_edited,
       CASE WHEN fingerprint = next_fingerprint THEN 1.0::DOUBLE WHEN hz = 0 THEN 0.0::DOUBLE ELSE sz::DOUBLE / hz END AS near_next
FROM m
"""

# 8 + 8 + 7 characters mark a turn and 1 ends its line; the mask takes 8 + 9
_ESCAPED = "regexp_replace({}, '[\\\\<\\[|]', '--', 'g')"
OP6_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(24 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})
                + CASE WHEN role = 'assistant' THEN 17 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

OP11_SQL = """
WITH p AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, rest, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x:
           x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) AS kept
  FROM p),
c AS (
  SELECT page_id, host, path, CASE WHEN rest IS NOT NULL THEN
           regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), '\\.*(:(80|443)?)?$', ''), '^www\\.', '')
           || regexp_replace(path, '(/index\\.html?)?/*$', '')
           || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM h),
listed AS (
  SELECT DISTINCT canonical FROM c
  WHERE canonical IS NOT NULL AND regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)')),
rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best AS (
  SELECT page_id, max_by(r_host || r_path, length(r_host || r_path)) AS rule,
         max_by(r_verdict, length(r_host || r_path)) AS r_verdict
  FROM c JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path) GROUP BY page_id)
SELECT page_id, host, path, rule, canonical,
       coalesce(r_verdict, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN best USING (page_id)
"""


def _op12_fold(name: str, nodes: str, levels: int) -> str:
    """CTEs {name}1 .. {name}<levels>: runs of 16 of the level below, a tree of one node as it is."""
    out = []
    for k in range(1, levels + 1):
        out.append(f"""
{name}{k} AS (
  SELECT tree, idx // 16 AS idx, list(h ORDER BY idx) AS hs, any_value(width) AS below, (any_value(width) + 15) // 16 AS width,
         CASE WHEN any_value(width) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h
  FROM {nodes if k == 1 else f"{name}{k - 1}"} GROUP BY tree, idx // 16)""")
    return ",".join(out)


def _op12_climb(rows: str, name: str, tree: str, idx: str, levels: int, out: str) -> str:
    """CTEs that add each level's siblings to `proof` and fold `f` with them."""
    made = []
    for k in range(1, levels + 1):
        p = f"CAST(({idx} // {16 ** (k - 1)}) % 16 AS INT)"
        made.append(f"""
{out}{k} AS (
  SELECT r.* REPLACE (
    CASE WHEN n.below > 1 THEN r.proof || array_to_string(n.hs[1:{p}] || n.hs[{p} + 2:], '') ELSE r.proof END AS proof,
    CASE WHEN n.below > 1 THEN sha256(array_to_string(n.hs[1:{p}] || [r.f] || n.hs[{p} + 2:], '')) ELSE r.f END AS f)
  FROM {rows if k == 1 else f"{out}{k - 1}"} r JOIN {name}{k} n ON n.tree = {tree} AND n.idx = {idx} // {16 ** k})""")
    return ",".join(made)


_OP12_ENC = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END"
_OP12_LEAF = "sha256({} || {} || {} || {} || {})"
_OP12_HEAD = [_OP12_ENC.format(c) for c in ("doc_id", "source", "lang", "n_chars")]
# the CRC of the decimal digits, a bit at a time (reflected polynomial of IEEE 802.3)
_OP12_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
             "lambda c: ascii(c)::BIGINT)), lambda a, c: list_reduce(list_prepend(xor(a, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
             "lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")
OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, source, {_OP12_LEAF.format(*_OP12_HEAD, _OP12_ENC.format("text"))} AS leaf,
         CASE WHEN {_OP12_CRC} % 5 = 0 THEN {_OP12_LEAF.format(*_OP12_HEAD, _OP12_ENC.format(
             "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"))} END AS changed
  FROM documents),
e AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS width FROM d),
l0 AS (SELECT tree, idx, leaf AS h, width FROM e),{_op12_fold("l", "l0", 6)},
t0 AS (SELECT 0 AS tree, tree AS idx, h, (SELECT count(*) FROM l6) AS width FROM l6),{_op12_fold("t", "t0", 4)},
c0 AS (SELECT doc_id, source, leaf, tree, idx, '' AS proof, coalesce(changed, leaf) AS f FROM e),
{_op12_climb("c0", "l", "r.tree", "r.idx", 6, "c")},
{_op12_climb("c6", "t", "0", "r.tree", 4, "s")}
SELECT s4.doc_id, s4.source, leaf, l6.h AS subroot, t4.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t4.h AS verified
FROM s4 JOIN l6 ON l6.tree = s4.tree CROSS JOIN t4
"""

OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS m
  FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, m, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, m),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
         CAST(1 << (ascii(substr(filter_order, step, 1)) - 65) AS INT) AS bit,
         CAST(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(substr(filter_order, k, 1)) - 65))) AS INT) AS gone
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, letter,
         CAST(sum(CASE WHEN m & (coalesce(gone, 0) | bit) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN m & bit > 0 AND m & coalesce(gone, 0) = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN m & bit > 0 AND m & coalesce(gone, 0) > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN m = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN m & bit > 0 AND m & coalesce(gone, 0) = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN m & bit > 0 AND m & coalesce(gone, 0) = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""

QUERIES = {
    "op1_imatch": op1_imatch,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_mix_sources": op4_mix_sources,
    "op5_shards": op5_shards,
    "op6_chat_format": op6_chat_format,
    "op7_edit_counts": op7_edit_counts,
    "op8_ngram_score": op8_ngram_score,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_url_filter": op11_url_filter,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_filter_audit": op13_filter_audit,
}

SQL = {
    "op1_imatch": OP1_SQL,
    "op4_mix_sources": OP4_SQL,
    "op6_chat_format": OP6_SQL,
    "op11_url_filter": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
