"""The registered queries: each applies one operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from extractkit.llm import bpe, exact_dedup, merkle, quality_classifier, quality_rules, urls
from extractkit.llm.chat import ChatFormat
from extractkit.llm.common import load, stored
from extractkit.llm.licenses import scan_licenses
from extractkit.llm.minhash import near_duplicates
from extractkit.llm.packing import pack_documents
from extractkit.llm.prefix_trie import assembled, prefix_trie, with_shared_heads
from extractkit.llm.token_counts import TokenRollup, deleted, inserted, revised
from extractkit.llm.topk import quantised, top_k
from extractkit.session import scratch_path


def op1_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents come in; all counts are revised to take in the end-of-text token; toxic documents go; the first batch comes again."""
    docs = load(spark, folder, "documents").select("doc_id", "source", "lang", F.length("text").cast("long").alias("n_chars"), "text")
    counted = bpe.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    counts = stored(counted.withColumn("tokenizer", F.lit("byte_bpe_50k")), "token-counts")
    ended = counts.withColumns({"n_tokens": F.col("n_tokens") + 1, "tokenizer": F.lit("byte_bpe_50k+end")})
    toxic = load(spark, folder, "labels").where("toxic = 1").select("doc_id").distinct()
    rollup = TokenRollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("load", inserted(counts))
    rollup.commit("revise", revised(counts, ended))
    rollup.commit("takedown", deleted(ended.join(toxic, "doc_id", "left_semi")))
    rollup.commit("load", inserted(counts))
    return rollup.totals()


#: (verdict, host, path)
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
#: A small table of URLs labelled by hand.
LABELLED_URLS = {
    1: ("http://spam-farm.example.org/en/728", "https://casino-win.example.net/en/12", "http://cheap-pills.example.net/de/45", "http://free-bets.example.net/en/9",
        "https://adult-x.example.com/fr/77", "http://ads-track.example.com/en/31?utm_source=feed", "http://www.online-casino.example.org/play", "http://buy-pills.example.org/order",
        "http://spam-links.example.com/es/5", "https://adult-cams.example.net/en/88", "http://bets-free.example.org/win", "http://track-ads.example.net/click?id=1"),
    0: ("https://www.ththes.example.net/en/410", "http://blog.ththre.example.org/en/393", "https://m.tiontion.example.com/de/120", "http://therer.example.net/en/555",
        "https://ththing.example.com/en/676", "http://news.example.org/en/2024/report.html", "https://docs.example.com/en/guide/", "http://www.city-library.example.org/de/books",
        "https://thertion.example.com/en/825?page=2&ref=x", "http://school.example.net/en/lessons/3", "https://wiki.example.org/en/Main_Page", "http://theran.example.org/de/174#top",
        "https://blog.tionsh.example.net/en/533/", "http://m.ththth.example.org/en/25"),
}


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(f"('{url}', {block})" for block, found in LABELLED_URLS.items() for url in found)
    weights = urls.train(spark.sql(f"SELECT * FROM VALUES {values} AS t(url, block)"))
    return urls.judged(load(spark, folder, "pages").select("page_id", "url"), URL_RULES, weights).drop("url")


def op3_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(load(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    counted = stored(quality_rules.with_counts(load(spark, folder, "documents").select("doc_id", "text")).drop("text"), "counts")
    model = quality_rules.fit(counted)
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", quality_rules.base_failed().alias("base_failed"),
        model.posterior().alias("quality"), model.kept().alias("kept"),
    )


def op5_branch_and_bound_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load(spark, folder, "embeddings").select("vec_id", quantised(F.col("embedding"), 1024).alias("values"))
    return top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


OP5_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


def op6_cotrained_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    model = quality_classifier.fit(docs, load(spark, folder, "labels"))
    return quality_classifier.score(docs, model).drop("text")


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(load(spark, folder, "documents"))


def op8_two_tier_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(load(spark, folder, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(load(spark, folder, "documents"), width=4, percent=80)


#: A conversation whose texts look like the template's own strings.
CONTROL_CONVERSATION = """SELECT CAST(-1 AS BIGINT) AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
    FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"""


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    chat = ChatFormat()
    rows = load(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(CONTROL_CONVERSATION))
    out = chat.format(rows)
    read = out.select("conv_id", "formatted", "error_turn", chat.read(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.col("error_turn").cast("long").alias("error_turn"),
    )


OP10_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS n,
        lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
        length(text) + len(regexp_extract_all(text, '\[\\*/?INST\]|<\\*(<SYS>>|</SYS>>|/?s>|\|role\|>|\|text\|>|\|end\|>)')) AS escaped
    FROM c
), f AS (
    SELECT *, CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
        WHEN before = 'user' THEN role = 'assistant' WHEN before = 'assistant' THEN role = 'user' ELSE false END AS fits
    FROM e
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(escaped + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 23 + length(role) END) AS BIGINT) AS formatted_chars,
    CAST(coalesce(min(n) FILTER (WHERE NOT fits), CASE WHEN arg_max(role, n) <> 'assistant' THEN count(*) END) AS BIGINT) AS error_turn
FROM f GROUP BY conv_id
"""

def merkle_report(docs: DataFrame) -> DataFrame:
    """Each row with its digests and proof, and what a check of its leaf finds; every fifth document or so is checked with a changed text.

    A row without an id is not changed.
    """
    told = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf(*told, lowered))
    leaves = docs.select("doc_id", "source", merkle.leaf(*told, F.col("text")).alias("leaf"), F.unhex(changed).alias("changed"))
    found = merkle.manifest(leaves, "source", "doc_id", carry=("doc_id", "changed"))
    checked = found.withColumn("folded_root", merkle.fold(F.coalesce(F.lower(F.hex("changed")), "leaf"), F.col("path")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("path", "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_report(load(spark, folder, "documents"))


#: Unsigned CRC-32 of a text of ASCII characters: each byte goes in, then eight shifts of the reversed polynomial.
CRC32_SQL = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
        flatten(list_transform(string_split({0}, ''), lambda c: [CAST(ascii(c) AS BIGINT), 256, 256, 256, 256, 256, 256, 256, 256]))),
        lambda a, e: CASE WHEN e < 256 THEN xor(a, e) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""


def _node_sql(name: str, first: str) -> str:
    """Common table expressions: ``{name}`` with the nodes of all levels, ``{name}_beside`` with what stands left and right of each."""
    return f"""{name}(level, tree, pos, size, digest) AS (
    {first}
    UNION ALL SELECT level + 1, tree, pos // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name}
    WHERE size > 1 GROUP BY level, tree, pos // 16, size
), {name}_beside AS (
    SELECT level, tree, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
        coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name} WHERE size > 1 WINDOW w AS (PARTITION BY level, tree, pos // 16 ORDER BY pos)
)"""


def _path_sql(name: str, nodes: str, first: str) -> str:
    """A common table expression that climbs ``nodes`` from ``first`` (row, level, tree, pos, proof, folded)."""
    return f"""{name}(row, level, tree, pos, proof, folded) AS (
    {first}
    UNION ALL SELECT p.row, p.level + 1, p.tree, p.pos // 16, p.proof || b.l || b.r, sha256(b.l || p.folded || b.r)
    FROM {name} p JOIN {nodes}_beside b USING (level, tree, pos)
)"""


_FIELDS_SQL = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
OP11_SQL = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, source, sha256({_FIELDS_SQL} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN {CRC32_SQL.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS found,
        lang, n_chars FROM documents
), e AS (
    SELECT doc_id, leaf, sha256({_FIELDS_SQL} || coalesce(strlen(found) || ':' || found, '-')) AS checked,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS size, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS row FROM d
), {_node_sql("node", "SELECT CAST(0 AS BIGINT), tree, pos, size, leaf FROM e")},
sub AS (SELECT tree, digest FROM node WHERE size = 1),
{_node_sql("top", "SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), tree, count(*) OVER (), digest FROM sub")},
{_path_sql("low", "node", "SELECT row, CAST(0 AS BIGINT), tree, pos, '', checked FROM e")},
{_path_sql("high", "top", "SELECT row, CAST(0 AS BIGINT), CAST(0 AS BIGINT), tree, proof, folded FROM (SELECT *, max(level) OVER (PARTITION BY row) AS last FROM low) WHERE level = last")},
ended AS (SELECT row, proof, folded FROM (SELECT *, max(level) OVER (PARTITION BY row) AS last FROM high) WHERE level = last)
SELECT e.doc_id, e.leaf, sub.digest AS subroot, root.digest AS root, sha256(ended.proof) AS proof_sha256, ended.folded AS folded_root,
    ended.folded = root.digest AS verified
FROM e JOIN sub USING (tree) JOIN ended USING (row) CROSS JOIN (SELECT digest FROM top WHERE size = 1) root
"""


def op12_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    recipes = exact_dedup.as_recipes(docs, exact_dedup.verified_seed(docs))
    told = recipes.select("doc_id", "recipe", F.sha2("text", 256).alias("text_sha256"))
    return exact_dedup.equal_recipes(told).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP12_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, sha256(text) AS text_sha256 FROM t WINDOW w AS (PARTITION BY text))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    conversations = stored(assembled(load(spark, folder, "conversations")), "assembled")
    return prefix_trie(with_shared_heads(conversations))


OP13_SQL = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (SELECT DISTINCT conv_id, {CRC32_SQL.format("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM t
), r AS (
    SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, n) AS n FROM (
        SELECT c.conv_id, 0 AS part, n, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND n <= h
        UNION ALL SELECT c.conv_id, 1, n, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND n > h)
), m AS (
    SELECT conv_id, n AS depth, length(text) AS chars,
        sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '' ORDER BY n) OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING)) AS key
    FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM c
), k AS (SELECT *, lag(key) OVER w AS up, lead(key) OVER w IS NULL AS ends FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), node AS (
    SELECT key, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
        sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM k GROUP BY key, depth
), kids AS (SELECT up AS key, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up
), sums AS (
    SELECT k.key, count(*) FILTER (WHERE kids.key IS NULL) AS n_leaves, CAST(sum((n_convs - 1) * node.chars) AS BIGINT) AS saved_tokens
    FROM node JOIN k ON k.conv_id = node.conv_id AND k.depth <= node.depth LEFT JOIN kids ON kids.key = node.key GROUP BY k.key
)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, node.ends_sha256
FROM node JOIN sums ON sums.key = node.key LEFT JOIN kids ON kids.key = node.key LEFT JOIN node parent ON parent.key = node.up
"""

#: name -> (function, SQL or None)
QUERIES = {
    "op1_token_rollup": (op1_token_rollup, None),
    "op2_url_filter": (op2_url_filter, None),
    "op3_best_two_fit": (op3_best_two_fit, None),
    "op4_quality_rules": (op4_quality_rules, None),
    "op5_branch_and_bound_topk": (op5_branch_and_bound_topk, OP5_SQL),
    "op6_cotrained_quality": (op6_cotrained_quality, None),
    "op7_license_scan": (op7_license_scan, None),
    "op8_two_tier_bpe": (op8_two_tier_bpe, None),
    "op9_minhash_dedup": (op9_minhash_dedup, None),
    "op10_chat_format": (op10_chat_format, OP10_SQL),
    "op11_merkle_manifest": (op11_merkle_manifest, OP11_SQL),
    "op12_chunk_recipes": (op12_chunk_recipes, OP12_SQL),
    "op13_prefix_trie": (op13_prefix_trie, OP13_SQL),
}
