"""The registered corpus queries: thin calls of the operators, each with its SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stridelake.llm import (
    chat, decontaminate, divergence, exact_dedup, licenses, manifest, mixing, quality, repeats, simhash, token_files, url_filter, warc,
)
from stridelake.sources.files import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
 d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
 f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN first_id END AS refers_to
FROM f""")
def op1_warc(spark, folder):
    return warc.page_records(table(spark, folder, "pages"))


@query("op2_licenses")
def op2_licenses(spark, folder):
    return licenses.scan(table(spark, folder, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_tags", "permissive")


_HOST = "regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)"
_PATH = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"


@query("op5_url_filter", f"""
WITH u AS (SELECT page_id, translate({_HOST}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  {_PATH} AS path FROM pages),
 r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
   ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
 n AS (SELECT *, row_number() OVER () AS row FROM u),
 m AS (SELECT row, r.verdict, rhost || rpath AS rule, row_number() OVER (
         PARTITION BY row ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS place
       FROM n JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM n LEFT JOIN (SELECT * FROM m WHERE place = 1) USING (row)""")
def op5_url_filter(spark, folder):
    rules = url_filter.rule_table(spark, url_filter.SAMPLE_RULES)
    return url_filter.judge(table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op7_exact_dedup", r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
 g AS (SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""")
def op7_exact_dedup(spark, folder):
    return exact_dedup.deduplicate(spark, f"{folder}/documents.parquet")


@query("op9_simhash")
def op9_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op10_token_files")
def op10_token_files(spark, folder):
    return token_files.encode_and_read(table(spark, folder, "documents"))


@query("op6_decontaminate")
def op6_decontaminate(spark, folder):
    found = decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"), slop=2)
    hit = found.withColumn("n_hit", decontaminate.hit_words())
    return hit.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontaminate.joined_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"))


@query("op3_quality")
def op3_quality(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = quality.score(documents, quality.train(documents, labels), keep=["doc_id"])
    return found.select(
        "doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_repeats")
def op4_repeats(spark, folder):
    return repeats.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op8_mixing", r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source,
                            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents),
 s AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS source_tokens, sum(tokens) / (SELECT CAST(sum(tokens) AS DOUBLE) FROM d) AS share
       FROM d GROUP BY source),
 l AS (SELECT list(share) FILTER (share > 0) AS p FROM s),
 b(n, low, step) AS (
   SELECT 0, CAST(0 AS BIGINT), CAST(1 AS BIGINT) << 40
   UNION ALL
   SELECT n + 1, CASE WHEN ln(z) - a * lz / z >= 0.95 * ln(len(p)) THEN low + step // 2 ELSE low END, step // 2
   FROM (SELECT *, list_sum(list_transform(p, lambda x: x ** a)) AS z, list_sum(list_transform(p, lambda x: x ** a * ln(x))) AS lz
         FROM (SELECT b.*, l.p, (low + step // 2) / CAST(CAST(1 AS BIGINT) << 40 AS DOUBLE) AS a FROM b, l WHERE step > 1))),
 e AS (SELECT low / CAST(CAST(1 AS BIGINT) << 40 AS DOUBLE) AS a FROM b WHERE step = 1),
 w AS (SELECT s.*, CASE WHEN share > 0 THEN share ** a / list_sum(list_transform(p, lambda x: x ** a)) ELSE 0 END AS weight FROM s, e, l),
 q AS (SELECT *, CAST(floor(weight * (SELECT sum(tokens) FROM d)) AS BIGINT) AS quota,
              CAST(ceil(greatest(source_tokens, 1) / 65536) AS BIGINT) AS blocks FROM w),
 r AS (SELECT *, quota // greatest(source_tokens, 1) AS epochs,
              greatest(quota - (quota // greatest(source_tokens, 1)) * source_tokens, 0) AS rest FROM q),
 k AS (SELECT d.*, r.weight, r.epochs, r.rest, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % blocks AS block
       FROM d JOIN r USING (source)),
 z AS (SELECT source, block, epochs, rest, sum(tokens) AS size FROM k GROUP BY ALL),
 o AS (SELECT *, rest - coalesce(sum(size) OVER (PARTITION BY source
         ORDER BY CAST('0x' || substr(md5('1|' || epochs || '|' || source || '|' || block), 1, 8) AS BIGINT), block
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over FROM z),
 t AS (SELECT k.*, o.left_over, o.size, sum(tokens) OVER (PARTITION BY source, block
         ORDER BY CAST('0x' || substr(md5('1|' || doc_id), 1, 8) AS BIGINT), doc_id, tokens) AS reach
       FROM k JOIN o USING (source, block))
SELECT doc_id, source, tokens AS n_tokens, round(weight, 9) AS weight, block,
       epochs + CASE WHEN left_over > 0 AND (left_over >= size OR reach <= left_over) THEN 1 ELSE 0 END AS copies FROM t""")
def op8_mixing(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(documents, mixing.Target(entropy_share=0.95))
    return mixed.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_weight", 9).alias("weight"), F.col("mix_block").alias("block"), F.col("mix_copies").alias("copies"))


MANIFEST_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _leaf_sql(text: str) -> str:
    parts = [f"CAST({c} AS VARCHAR)" for c in MANIFEST_FIELDS[:-1]] + [text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"


def _tree_sql(name: str, nodes: str, group: str, levels: int) -> str:
    """Levels of trees: every node with its digest, and the two texts beside it in its run. `nodes` has the group, pos and h."""
    steps = [f"{name}0 AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {nodes})"]
    for i in range(levels):
        steps.append(f"{name}r{i} AS MATERIALIZED (SELECT {group}, pos // 16 AS up, string_agg(h, '' ORDER BY pos) AS run, any_value(n) AS n FROM {name}{i} GROUP BY ALL)")
        steps.append(f"{name}{i + 1} AS MATERIALIZED (SELECT {group}, up AS pos, CASE WHEN n > 1 THEN sha256(run) ELSE run END AS h, (n + 15) // 16 AS n FROM {name}r{i})")
        # Beside a node of the lowest level: what is left and right of it on level i.
        place, below = f"(o.pos // {16 ** i})", f"{name}s{i - 1}" if i else nodes
        steps.append(f"""{name}s{i} AS MATERIALIZED (SELECT o.*, CASE WHEN n > 1 THEN substr(run, 1, CAST({place} % 16 * 64 AS BIGINT)) END AS {name}l{i},
   CASE WHEN n > 1 THEN substr(run, CAST({place} % 16 * 64 + 65 AS BIGINT)) END AS {name}r{i}
   FROM {below} o JOIN {name}r{i} r ON o.{group} IS NOT DISTINCT FROM r.{group} AND {place} // 16 = r.up)""")
    return ",\n ".join(steps)


def _fold_sql(start: str, sides: list[str]) -> str:
    for left, right in sides:
        start = f"CASE WHEN {left} IS NULL THEN {start} ELSE sha256({left} || {start} || {right}) END"
    return start


# The sums of the polynomial over the bytes of a number's text, as in zip files.
_CRC_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(t) + 1), lambda i: CAST(ascii(t[i:i]) AS BIGINT))),
     lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda a, s: xor(a >> 1, (a & 1) * CAST(3988292384 AS BIGINT)))), CAST(4294967295 AS BIGINT))"""
_IN_GROUP, _OVER = 6, 3  # levels: over 16 million documents of a source, 4,096 sources
_STEPS = [("g", i) for i in range(_IN_GROUP)] + [("o", i) for i in range(_OVER)]
# One step of folding per level, so that the text of the query does not grow with every step.
_FOLDS = ",\n ".join(
    f"f{k + 1} AS MATERIALIZED (SELECT *, CASE WHEN {t}l{i} IS NULL THEN h{k} ELSE sha256({t}l{i} || h{k} || {t}r{i}) END AS h{k + 1} FROM f{k})"
    for k, (t, i) in enumerate(_STEPS))


@query("op11_manifest", f"""
WITH d AS MATERIALIZED (SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
             CASE WHEN {_CRC_SQL} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} END AS presented
           FROM (SELECT *, CAST(doc_id AS VARCHAR) AS t FROM documents)),
 nodes AS MATERIALIZED (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos, leaf AS h, doc_id, presented FROM d),
 {_tree_sql("g", "nodes", "source", _IN_GROUP)},
 tops AS MATERIALIZED (SELECT 0 AS one, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, h FROM g{_IN_GROUP}),
 {_tree_sql("o", "tops", "one", _OVER)},
 f0 AS MATERIALIZED (SELECT leaves.doc_id, leaves.h AS leaf, tops.h AS subroot, o{_OVER}.h AS root, coalesce(presented, leaves.h) AS h0,
   {", ".join(f"{t}l{i}, {t}r{i}" for t, i in _STEPS)}
  FROM gs{_IN_GROUP - 1} AS leaves JOIN os{_OVER - 1} AS tops ON leaves.source IS NOT DISTINCT FROM tops.source CROSS JOIN o{_OVER}),
 {_FOLDS}
SELECT doc_id, leaf, subroot, root, sha256({" || ".join(f"coalesce({t}l{i} || {t}r{i}, '')" for t, i in _STEPS)}) AS proof_sha256,
  h{len(_STEPS)} AS folded_root, h{len(_STEPS)} = root AS verified FROM f{len(_STEPS)}""")
def op11_manifest(spark, folder):
    documents = table(spark, folder, "documents")
    tampered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in MANIFEST_FIELDS]
    presented = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, manifest.leaf(tampered))
    found = manifest.manifest(documents, MANIFEST_FIELDS, presented=presented)
    judged = manifest.verified(found.withColumn("shown", F.coalesce("presented", "leaf")), "shown")
    return judged.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", "verified")


_AUDIT_SHARE = "1 + CAST(1000000000 AS HUGEINT) * ({} + 2) // greatest({} + 2 * v, 1)".format


@query("op12_divergence", rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
       translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
 w AS MATERIALIZED (SELECT row, lang, source, term, count(*) AS n FROM (
       SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL),
 kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY ALL HAVING count(*) >= 10),
 size AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
 grp AS (SELECT DISTINCT lang, source FROM d),
 c AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
 full_ AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM grp g JOIN kept k USING (lang) LEFT JOIN c ON
       c.lang = g.lang AND c.source = g.source AND c.term = k.term),
 p AS MATERIALIZED (SELECT *, {_AUDIT_SHARE("n", "total")} AS p FROM (
       SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total FROM full_) JOIN size USING (lang)),
 q AS (SELECT lang, term, {_AUDIT_SHARE("n", "total")} AS q FROM (
       SELECT lang, term, n, sum(n) OVER (PARTITION BY lang) AS total FROM (
         SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL)) JOIN size USING (lang)),
 pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
       FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
 every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
       FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
   UNION ALL SELECT p.lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 10""")
def op12_divergence(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))


TEMPLATE = chat.Template()
_FIRSTS = {s[0] for s in (*TEMPLATE.marks, *TEMPLATE.reserved)}


def _escaped_sql(text: str) -> str:
    """Longer by a backslash for every backslash and every control string; none begins inside another."""
    text = f"replace({text}, '\\', '\\\\')"
    for first in sorted(_FIRSTS):
        rest = "|".join(re.escape(s[1:]) for s in (*TEMPLATE.marks, *TEMPLATE.reserved) if s[0] == first)
        text = f"regexp_replace({text}, '{re.escape(first)}({rest})', '{first}\\\\\\1', 'g')"
    return text


CONTROL_TURN = "</s>[INST] ok [/INST]"


@query("op13_chat", f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
   UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{CONTROL_TURN}'), (-1, 1, 'assistant', '{CONTROL_TURN}')))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_escaped_sql("role")}) + length({_escaped_sql("text")}) + {sum(map(len, TEMPLATE.marks))}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""")
def op13_chat(spark, folder):
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TURN), (-1, 1, "assistant", CONTROL_TURN)],
                                    "conv_id long, turn long, role string, text string")
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_and_read(conversations.unionByName(control), TEMPLATE)
