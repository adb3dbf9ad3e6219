"""The registered queries of this subpackage: each applies one operator, with its
default parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import (byte_ids, chat_grammar, decontaminate, fim_cuts, fst_tokens, hyper_lang, line_align, log_bilinear, mixing, orchard_codes, order_minhash,
                       perplexity_rules, zip_warc)
from quire.sources.tables import Tables

TOKENIZER = "word_bpe_49k.json"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


# Words, windows of 13 words (or the whole shorter item), and every occurrence
# as a run of equal words; a word is hit if some occurrence covers it.
DECONTAMINATE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, width, array_to_string(w[i:i + width - 1], ' ') AS gram
       FROM (SELECT item_id, w, least(13, len(w)) AS width, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
             FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT width FROM bw),
dw AS (SELECT r, width, i, array_to_string(w[i:i + width - 1], ' ') AS gram
       FROM (SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM d, widths WHERE len(w) >= width)),
m AS (SELECT dw.r, dw.width, dw.i, bw.item_id FROM dw JOIN bw USING (gram, width)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS p FROM m) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM m GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""


@register("op1_decontaminate", DECONTAMINATE)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return decontaminate.contamination_report(t.documents, t.benchmark).drop("n_near")


# Water filling: sources by cap / weight; the level is the first that stays under the next cap.
MIX = r"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM p),
a AS (SELECT *, cap / weight AS at_level,
             (SELECT sum(source_size) FROM p) AS total, (SELECT sum(weight) FROM w) AS weights,
             sum(cap) OVER o - cap AS capped, sum(weight) OVER o - weight AS gone
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT (total - capped) / (weights - gone) AS level FROM a WHERE (total - capped) / (weights - gone) <= at_level
      ORDER BY at_level, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), weight * (SELECT level FROM l)), 0.0) AS target FROM w),
r AS (SELECT s.doc_id, s.size, t.source_size, t.target,
             CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END AS rate,
             CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM r
"""


@register("op4_mix_sources", MIX)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(Tables(spark, sf_dir).documents)


@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text", "lang")
    return hyper_lang.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@register("op2_quality_perplexity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_rules.quality_rules(Tables(spark, sf_dir).documents)


# Turn lengths by template; every control string, escaped or not, gets one backslash.
CHAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, length(text)
             + len(regexp_extract_all(text, '<\\*(?:/?s>|</?SYS>>)|\[\\*(?:/?INST\]|/?ROLE\]|SAY\])'))
             + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17 ELSE 22 + length(role) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


@register("op3_chat_format", CHAT)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = Tables(spark, sf_dir).conversations.select("conv_id", "turn", "role", "text")
    same = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", same), (-7, 1, "assistant", same)], turns.schema)
    return chat_grammar.round_trip(turns.unionByName(more))


@register("op10_token_ids")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_ids.encode_documents(Tables(spark, sf_dir).documents, tokenizer_path())


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst_tokens.count_tokens(Tables(spark, sf_dir).documents, tokenizer_path())


@register("op6_order_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(Tables(spark, sf_dir).documents)


# The base score by SQL; the model's score has no SQL form and is tested apart.
@register("op8_log_bilinear")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score_texts(Tables(spark, sf_dir).documents)


@register("op5_line_align")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_align.line_report(Tables(spark, sf_dir).documents)


# Units by pattern, the parts as slices of their list; what is restored is the text itself.
FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
x AS (SELECT *, len(u) AS n, [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS r FROM d),
f AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                  WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@register("op11_fim_cuts", FIM)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_cuts.digests(Tables(spark, sf_dir).documents)


# Base 32: twenty bits of the digest are five hex digits and four letters.
WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, sha1(html) AS h, octet_length(encode(html)) AS bytes,
             row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS nth, first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS first_id FROM p)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31) + 1, 1)
                        FOR k IN range(32)], '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN first_id END AS refers_to
FROM d
"""


@register("op12_zip_warc", WARC)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zip_warc.archive_round_trip(Tables(spark, sf_dir).pages)


def _codes_sql(parts: int = 4, width: int = 64, entries: int = 256, rounds: int = 4) -> str:
    """Every round as two steps: the nearest entry of every part, then the floor of each entry's mean."""
    w = width // parts
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, part, any_value(x) AS x, min({{'d': d, 'entry': entry}}) AS best
  FROM (SELECT p.vec_id, p.part, p.x, b.entry, p.x2 - 2 * list_dot_product(p.x, b.x) + list_dot_product(b.x, b.x) AS d FROM p JOIN b{k} b USING (part))
  GROUP BY vec_id, part)""")
        if k < rounds:
            steps.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT part, entry, list(c ORDER BY pos) AS x FROM (
      SELECT part, entry, pos, floor(sum(c) / count(*)) AS c
      FROM (SELECT part, best.entry AS entry, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM a{k}) GROUP BY part, entry, pos)
    GROUP BY part, entry) m USING (part, entry))""")
    return f"""
WITH e AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS entry
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, entry, part, x, list_dot_product(x, x) AS x2
  FROM (SELECT vec_id, entry, part, v[part * {w} + 1:part * {w} + {w}] AS x FROM e, range({parts}) AS t(part))),
b0 AS (SELECT part, entry, x FROM p WHERE entry < {entries}),
{", ".join(steps)},
v AS (SELECT vec_id, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: CAST(c AS BIGINT)), ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN e USING (vec_id)
"""


@register("op13_orchard_codes", _codes_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard_codes.code_report(Tables(spark, sf_dir).embeddings)
