"""The registered queries of the operators, and their SQL where SQL can express them.

Each query runs its operator over a whole table with production settings and
derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    direct_codes,
    exact_dedup,
    language_id,
    merkle,
    near_dup,
    packing,
    pii,
    quality_rank,
    shard_shuffle,
    token_counts,
    turn_repair,
    url_rules,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# The rules and settings that the contracts of the queries name.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SHARDS = 24
PACK_FILE, PACK_END = "word_bpe_49k.json", 2
CODE_FILE, CODE_END = "byte_bpe_50k.json", 0
COUNT_FILE, COUNT_LIMIT = "piece_bpe_32k.model", 4096
FOLDS, HELD_OUT_FOLD = 4, 2

# a stand-in: deployments pass a secret of their own
PSEUDONYM_KEY = b"registered query"

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize_documents(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query(
    f"""
    WITH u AS (
      SELECT page_id, coalesce({_LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    r(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                            ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
    SELECT page_id, any_value(host) AS host, any_value(path) AS path,
           arg_max(rh || rp, length(rh || rp)) AS rule,
           coalesce(arg_max(v, length(rh || rp)), 'allow') AS verdict
    FROM u LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    GROUP BY page_id
    """
)
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


@query(
    """
    WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """
)
def op3_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.tree_dedup(table(spark, sf_dir, "documents"), keep="largest").drop("n_bytes")


@query()
def op4_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_windows(table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_FILE), PACK_END)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD


def quality_model(docs: DataFrame, labels: DataFrame, x_col: str | None = None) -> quality_rank.Model:
    """Fitted without the rows that are held out."""
    return quality_rank.train(docs, labels.where(~held_out()), x_col=x_col)


@query()
def op5_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rank.measure(table(spark, sf_dir, "documents"))
    model = quality_model(rows, table(spark, sf_dir, "labels"), x_col="x")
    return quality_rank.score_documents(rows, model, x_col="x").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_FILE), COUNT_LIMIT)


@query()
def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


@query()
def op8_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    segments = direct_codes.write_codes(docs, public_tokenizers.path(CODE_FILE), CODE_END)
    return direct_codes.read_documents(segments)


@query()
def op9_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return shard_shuffle.shards(shard_shuffle.external_shuffle(docs), SHARDS).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_WORDS = "coalesce(regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"


@query(
    f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_WORDS} AS w FROM documents),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    win AS (
      SELECT DISTINCT item_id, array_to_string(w[i + 1:i + 10], ' ') AS t, least(len(w), 10) AS s
      FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT s FROM win),
    dw AS (
      SELECT rid, i, s, array_to_string(w[i + 1:i + s], ' ') AS t
      FROM (SELECT rid, w, s, unnest(range(0, len(w) - s + 1)) AS i FROM d, sizes WHERE len(w) >= s)),
    occ AS (SELECT DISTINCT rid, i, s, t FROM dw WHERE (t, s) IN (SELECT (t, s) FROM win)),
    hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + s)) AS p FROM occ) GROUP BY rid),
    own AS (
      SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM occ JOIN win USING (t, s)) GROUP BY rid)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (rid) LEFT JOIN own USING (rid)
    """
)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


LANG_FOLDS, LANG_HELD_OUT_FOLD = 5, 0


@query()
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % LANG_FOLDS
    model = language_id.train(docs.where(fold != LANG_HELD_OUT_FOLD))
    named = language_id.identify(docs, model)
    return named.withColumn("held_out", F.coalesce(fold == LANG_HELD_OUT_FOLD, F.lit(False)))


# unsigned CRC-32 of an ASCII string, bit by bit
_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({0}) + 1), lambda i: ord({0}[i])::BIGINT)),"
    " lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),"
    " lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"
)


def _step(state: str, keep: str, after: str, turned: str) -> str:
    """Cheapest edits of a row and what follows in one grammar state; an insertion is weighed later."""
    line = "chr(10) || '{}:' || txt"
    return f"""list_min([
        {{'c': 4 + p.{state}.c, 'a': 'D' || p.{state}.a, 't': p.{state}.t}},
        CASE WHEN NOT gone AND initial IN ({keep}) THEN CASE initial
          {" ".join(f"WHEN '{k}' THEN {{'c': extra + p.{g}.c, 'a': 'K' || p.{g}.a, 't': chr(10) || role || ':' || txt || p.{g}.t}}" for k, g in after.items())} END END,
        CASE WHEN NOT gone THEN {{'c': 3 + extra + p.{turned[0]}.c, 'a': 'R' || p.{turned[0]}.a, 't': {line.format(turned)} || p.{turned[0]}.t}} END])"""


def _inserted(to: str, of: str) -> str:
    return f"{{'c': 3 + {of}.c, 'a': 'I' || {of}.a, 't': chr(10) || '{to}:' || {of}.t}}"


@query(
    f"""
    WITH RECURSIVE k AS (
      SELECT *, {_CRC32.format("key")} % 20 AS m FROM (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations)),
    d AS (
      SELECT conv_id, turn, CASE WHEN m = 4 THEN 'user' ELSE role END AS role,
             CASE m WHEN 1 THEN '' WHEN 2 THEN regexp_replace(txt, '[.!?]', '', 'g') ELSE txt END AS txt,
             unnest(CASE WHEN m = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM k WHERE m <> 0),
    o AS (
      SELECT *, role[1] AS initial, row_number() OVER c AS pos, coalesce(lag(role) OVER c, '')[1] AS prior,
             row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY turn NULLS FIRST, copy) > 1 AS again,
             regexp_extract(txt, '([^ \t-\r])[ \t-\r]*$', 1) AS final
      FROM d WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, txt, copy)),
    f AS (
      SELECT *, final = '' OR again AS gone, CASE WHEN final NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS extra FROM o),
    n AS (
      SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (final = '') AS blank, count(*) FILTER (final <> '' AND again) AS duplicate,
             count(*) FILTER (NOT gone AND extra > 0) AS truncated,
             count(*) FILTER (pos > 1 AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal
      FROM f GROUP BY conv_id),
    p(conv_id, pos, o, s, u, a) AS (
      SELECT conv_id, n + 1, {{'c': 0, 'a': '', 't': ''}}, {{'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}},
             {{'c': 3, 'a': 'I', 't': chr(10) || 'assistant:'}}, {{'c': 0, 'a': '', 't': ''}} FROM n
      UNION ALL
      SELECT conv_id, pos, list_min([o, {_inserted("user", "u2")}]), list_min([s, {_inserted("user", "u2")}]), u2, a2 FROM (
        SELECT *, list_min([u, {_inserted("assistant", "a")}]) AS u2, list_min([a, {_inserted("user", "u")}]) AS a2 FROM (
          SELECT p.conv_id, f.pos, {_step("o", "'s', 'u'", {"s": "s", "u": "u"}, "user")} AS o,
                 {_step("s", "'u'", {"u": "u"}, "user")} AS s, {_step("u", "'a'", {"a": "a"}, "assistant")} AS u,
                 {_step("a", "'u'", {"u": "u"}, "user")} AS a
          FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = p.pos - 1)))
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(p.o.c, 0)::BIGINT AS cost,
           coalesce(p.o.a, '') AS audit, sha256(coalesce(p.o.t[2:], '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.pos = 1
    """
)
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))
    return found.withColumn("conv_id", F.col("conv").cast("long")).drop("conv", "signature")


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


@query(
    f"""
    WITH RECURSIVE d AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM (
        SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(_LOWER.format("text"))} AS lowered,
               coalesce({_CRC32.format("(doc_id::VARCHAR)")} % 3 = 0, false) AS changed
        FROM documents)),
    l(lang, level, nodes) AS (
      SELECT lang, 0, list(leaf ORDER BY idx) FROM d GROUP BY lang
      UNION ALL
      SELECT lang, level + 1, list_transform(range(0, len(nodes), 8), lambda k: sha256(array_to_string(nodes[k + 1:k + 8], '')))
      FROM l WHERE len(nodes) > 1),
    sub AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS top_at FROM l WHERE len(nodes) = 1),
    t(level, nodes) AS (
      SELECT 0, list(subroot ORDER BY top_at) FROM sub
      UNION ALL
      SELECT level + 1, list_transform(range(0, len(nodes), 8), lambda k: sha256(array_to_string(nodes[k + 1:k + 8], '')))
      FROM t WHERE len(nodes) > 1),
    steps AS (
      SELECT d.idx, d.lang, false AS upper, l.level, l.nodes, d.idx // (8 ** l.level)::BIGINT AS p
      FROM d JOIN l ON l.lang IS NOT DISTINCT FROM d.lang AND len(l.nodes) > 1
      UNION ALL
      SELECT d.idx, d.lang, true, t.level, t.nodes, s.top_at // (8 ** t.level)::BIGINT
      FROM d JOIN sub s ON s.lang IS NOT DISTINCT FROM d.lang JOIN t ON len(t.nodes) > 1),
    sides AS (
      SELECT idx, lang, row_number() OVER (PARTITION BY lang, idx ORDER BY upper, level) AS step,
             array_to_string(nodes[p - p % 8 + 1:p], '') AS before, array_to_string(nodes[p + 2:p - p % 8 + 8], '') AS after
      FROM steps),
    proofs AS (SELECT idx, lang, sha256(string_agg(before || after, '' ORDER BY step)) AS proof FROM sides GROUP BY idx, lang),
    folds(idx, lang, step, node) AS (
      SELECT idx, lang, 0, CASE WHEN changed THEN lowered ELSE leaf END FROM d
      UNION ALL
      SELECT f.idx, f.lang, f.step + 1, sha256(s.before || f.node || s.after)
      FROM folds f JOIN sides s ON s.idx = f.idx AND s.lang IS NOT DISTINCT FROM f.lang AND s.step = f.step + 1),
    ends AS (SELECT idx, lang, arg_max(node, step) AS folded_root FROM folds GROUP BY idx, lang)
    SELECT d.doc_id, d.leaf, sub.subroot, root.nodes[1] AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
           folded_root = root.nodes[1] AS verified
    FROM d JOIN sub ON sub.lang IS NOT DISTINCT FROM d.lang JOIN t root ON len(root.nodes) = 1
    JOIN ends ON ends.idx = d.idx AND ends.lang IS NOT DISTINCT FROM d.lang
    LEFT JOIN proofs ON proofs.idx = d.idx AND proofs.lang IS NOT DISTINCT FROM d.lang
    """
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), merkle.tampered()).drop("lang")
