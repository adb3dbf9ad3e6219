"""Conversation, page-assembly and token-accounting queries over ``conversations``.

Message lists are returned in long form, ``(conv_id, pos, role, content)``,
computed without gathering a conversation (``messages_long``); the array
form is built only where the array is the result (``request_body``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import conversations as M
from quire.operators import tokens as TK
from quire.operators.classify import keyword_predict
from quire.plans.common import sql_keyword_predict
from quire.plans.registry import register
from quire.sources.tables import Tables

SYSTEM = "You are a helpful assistant that classifies documents."
PAGE_SPEC = "1-3,5,7-9"
SQL_TOK = r"len(regexp_extract_all({t}, '\p{{L}}+|\p{{N}}+|[^ \t\n\r\f\p{{L}}\p{{N}}]'))"


def _sql_tok(expr: str) -> str:
    return f"coalesce({SQL_TOK.format(t=expr)}, 0)"


def _conv(spark, sf_dir):
    return Tables(spark, sf_dir).conversations.select("conv_id", "turn", "role", "text")


_LAST = "a AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS mt FROM conversations)"


def _msgs_sql(parts: str) -> str:
    return f"""
WITH {_LAST},
m AS ({parts})
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY o, sub) - 1 AS INTEGER) AS pos, role, content
FROM m
"""


_HIST = "SELECT conv_id, turn AS o, 0 AS sub, role, text AS content FROM a WHERE turn < mt"
_SYS_AFTER = f"SELECT conv_id, mt, 1, 'system', '{SYSTEM}' FROM a WHERE turn = mt"
_SYS_FIRST = f"SELECT conv_id, -1 AS o, 0 AS sub, 'system' AS role, '{SYSTEM}' AS content FROM a WHERE turn = mt"
_USER = "SELECT conv_id, mt, 2, 'user', text FROM a WHERE turn = mt"


@register("chat_messages_async", oracle=_msgs_sql(" UNION ALL ".join([_HIST, _SYS_AFTER, _USER])))
def chat_messages_async(spark, sf_dir):
    return M.messages_long(_conv(spark, sf_dir), SYSTEM, "async")


@register("chat_messages_sync", oracle=_msgs_sql(" UNION ALL ".join([_SYS_FIRST, _HIST, _USER])))
def chat_messages_sync(spark, sf_dir):
    return M.messages_long(_conv(spark, sf_dir), SYSTEM, "sync")


@register("append_reply", oracle=_msgs_sql(" UNION ALL ".join([
    _HIST, _SYS_AFTER, _USER,
    "SELECT conv_id, mt, 3, 'user', text FROM a WHERE turn = mt",
    f"SELECT conv_id, mt, 4, 'system', {sql_keyword_predict('text')} FROM a WHERE turn = mt"])))
def append_reply(spark, sf_dir):
    """The model's reply (here the keyword model on the prompt) is stored with role 'system'."""
    return M.messages_long(_conv(spark, sf_dir), SYSTEM, "async", reply=keyword_predict("prompt"),
                           reply_role="system")


@register("content_parts", oracle="""
SELECT conv_id, turn, 0 AS pos, 'text' AS type, text, NULL::VARCHAR AS url, true AS parts_valid FROM conversations
UNION ALL
SELECT conv_id, turn, 1, 'image_url', NULL, 'conv/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) || '.png',
       true
FROM conversations
""")
def content_parts(spark, sf_dir):
    c = _conv(spark, sf_dir)
    url = F.concat(F.lit("conv/"), F.col("conv_id").cast("string"), F.lit("/"),
                   F.col("turn").cast("string"), F.lit(".png"))
    parts = M.content_parts(F.col("text"), F.array(url))
    return (c.select("conv_id", "turn", M.parts_valid(parts).alias("parts_valid"),
                     F.posexplode(parts).alias("pos", "p"))
            .select("conv_id", "turn", "pos", "p.type", "p.text", "p.url", "parts_valid"))


@register("content_parts_images_first", oracle="""
WITH u AS (SELECT conv_id, turn, text, ['conv/' || conv_id || '/' || turn || '-' || k || '.png' FOR k IN range(1, turn % 3 + 1)] AS urls FROM conversations)
SELECT conv_id, turn, CAST(generate_subscripts(urls, 1) - 1 AS INTEGER) AS pos, 'image_url' AS type, NULL::VARCHAR AS text, unnest(urls) AS url FROM u
UNION ALL SELECT conv_id, turn, CAST(len(urls) AS INTEGER), 'text', text, NULL FROM u
""")
def content_parts_images_first(spark, sf_dir):
    """P17 the other way round: none, one or two images before the text."""
    c = _conv(spark, sf_dir)
    stem = F.concat(F.lit("conv/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"), F.lit("-"))
    count = (F.col("turn") % 3).cast("int")
    urls = F.transform(F.filter(F.array(F.lit(1), F.lit(2)), lambda k: k <= count), lambda k: F.concat(stem, k.cast("string"), F.lit(".png")))
    return (c.select("conv_id", "turn", F.posexplode(M.content_parts(F.col("text"), urls, image_first=True)).alias("pos", "p"))
            .select("conv_id", "turn", "pos", "p.type", "p.text", "p.url"))


@register("message_valid", oracle="""
SELECT conv_id,
       (count(*) FILTER (WHERE role IS NULL OR text IS NULL)
        - CASE WHEN arg_max(role IS NULL OR text IS NULL, turn) THEN 1 ELSE 0 END) = 0
       AND NOT arg_max(text IS NULL, turn) AS valid
FROM conversations GROUP BY conv_id
""")
def message_valid(spark, sf_dir):
    return M.conversations_valid(_conv(spark, sf_dir))


_BODY_SQL = f"""
WITH {_LAST},
m AS ({" UNION ALL ".join([_HIST, _SYS_AFTER, _USER])}),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY o, sub) - 1 AS pos FROM m),
q AS (SELECT conv_id, CAST(pos // {M.PART_ROWS} AS INTEGER) AS part_no,
             string_agg(to_json(struct_pack(role := role, content := content))::VARCHAR, ',' ORDER BY pos) AS t
      FROM p GROUP BY conv_id, pos // {M.PART_ROWS})
SELECT conv_id, part_no, CASE WHEN part_no = 0 THEN '{{"messages":[' ELSE ',' END || t
       || CASE WHEN part_no = max(part_no) OVER (PARTITION BY conv_id) THEN '],"temperature":0.0,"max_tokens":4000,"top_p":0.95}}'
               ELSE '' END AS body
FROM q
"""


def _parts_sql(out: str, sep: str, where: str) -> str:
    return f"""
WITH r AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos
           FROM conversations WHERE text IS NOT NULL AND {where})
SELECT conv_id, CAST(pos // {M.PART_ROWS} AS INTEGER) AS part_no,
       CASE WHEN pos // {M.PART_ROWS} = 0 THEN '' ELSE {sep} END || string_agg(text, {sep} ORDER BY turn) AS {out}
FROM r GROUP BY conv_id, pos // {M.PART_ROWS}
"""


@register("request_body", oracle=_BODY_SQL)
def request_body(spark, sf_dir):
    return M.body_parts(M.messages_long(_conv(spark, sf_dir), SYSTEM, "async"), "conv_id")


@register("assemble_deltas", oracle=_parts_sql("reply", "''", "role = 'assistant'"))
def assemble_deltas(spark, sf_dir):
    c = _conv(spark, sf_dir).filter(F.col("role") == "assistant")
    return M.assemble_deltas(c, "conv_id", "turn", "text")


@register("last_turn_flag", oracle="""
SELECT conv_id, arg_max(text, turn) AS last_text,
       coalesce(length(arg_max(text, turn)) > 0, false) AND coalesce(contains(lower(arg_max(text, turn)), 'yes'), false) AS wants_image
FROM conversations GROUP BY conv_id
""")
def last_turn_flag(spark, sf_dir):
    return M.last_turn_flag(_conv(spark, sf_dir), "conv_id", "turn", "text")


@register("join_pages", oracle=_parts_sql("text", "chr(10)", "true"))
def join_pages(spark, sf_dir):
    return M.join_pages(_conv(spark, sf_dir), "conv_id", "turn", "text")


@register("doc_page_count", oracle="""
SELECT conv_id, count(*) AS n_pages, arg_min(role, turn) AS role FROM conversations GROUP BY conv_id
""")
def doc_page_count(spark, sf_dir):
    return M.page_count(_conv(spark, sf_dir), "conv_id", "turn", ["role"])


@register("page_names", oracle="""
SELECT conv_id, turn, 'conv_' || CAST(conv_id AS VARCHAR) || '-page-' || CAST(turn + 1 AS VARCHAR) || '.png' AS name
FROM conversations
""")
def page_names(spark, sf_dir):
    c = _conv(spark, sf_dir)
    stem = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"))
    return c.select("conv_id", "turn", M.page_names(c, stem, F.col("turn") + 1).alias("name"))


@register("page_selector", oracle="""
SELECT conv_id, turn, role, text FROM conversations
WHERE turn + 1 BETWEEN 1 AND 3 OR turn + 1 = 5 OR turn + 1 BETWEEN 7 AND 9
""")
def page_selector(spark, sf_dir):
    return M.select_pages(_conv(spark, sf_dir), F.col("turn") + 1, PAGE_SPEC)


# ---- tokens -------------------------------------------------------------------

_EST_SQL = f"""
est AS (SELECT conv_id, CAST(sum(3 + {_sql_tok('role')} + {_sql_tok('text')}) + 3 AS BIGINT) AS estimated_tokens
        FROM conversations GROUP BY conv_id),
act AS (SELECT conv_id, CAST(sum(4 + ceil(length(text) / 4.0)) + 3 AS BIGINT) AS actual_tokens,
               CASE WHEN bool_or(role = 'assistant') THEN 200 ELSE 500 END AS status
        FROM conversations GROUP BY conv_id),
cmp AS (SELECT est.conv_id, estimated_tokens, actual_tokens FROM est JOIN act USING (conv_id) WHERE status = 200)
"""


def _actuals(c):
    """Service-reported usage stand-in: 4 per message + ceil(chars / 4), + 3; a
    conversation without an assistant turn is a failed call (status 500)."""
    return c.groupBy("conv_id").agg(
        (F.sum(F.lit(4) + F.ceil(F.length("text") / 4.0)) + 3).cast("long").alias("actual_tokens"),
        F.when(F.bool_or(F.col("role") == "assistant"), F.lit(200)).otherwise(F.lit(500)).alias("status"))


def _cmp(spark, sf_dir):
    c = _conv(spark, sf_dir)
    return TK.compare(TK.estimate_conversations(c), _actuals(c), "conv_id")


@register("token_estimate", oracle=f"WITH {_EST_SQL} SELECT * FROM est")
def token_estimate(spark, sf_dir):
    return TK.estimate_conversations(_conv(spark, sf_dir))


@register("text_tokens", oracle=f"SELECT doc_id, CAST({_sql_tok('text')} AS INTEGER) AS tokens FROM documents")
def text_tokens(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "text")
    return d.select("doc_id", TK.regex_tokens("text").alias("tokens"))


@register("token_compare", oracle=f"WITH {_EST_SQL} SELECT * FROM cmp")
def token_compare(spark, sf_dir):
    return _cmp(spark, sf_dir)


@register("token_accuracy", oracle=f"""
WITH {_EST_SQL}
SELECT conv_id, CASE WHEN actual_tokens > 0 THEN estimated_tokens::DOUBLE / actual_tokens * 100 ELSE 0.0 END AS accuracy
FROM cmp
UNION ALL
SELECT NULL, CASE WHEN sum(actual_tokens) > 0 THEN sum(estimated_tokens)::DOUBLE / sum(actual_tokens) * 100 ELSE 0.0 END
FROM cmp
""")
def token_accuracy(spark, sf_dir):
    cmp = _cmp(spark, sf_dir)
    per = cmp.select("conv_id", TK.accuracy(F.col("estimated_tokens"), F.col("actual_tokens")).alias("accuracy"))
    tot = cmp.agg(TK.accuracy(F.sum("estimated_tokens"), F.sum("actual_tokens")).alias("accuracy"))
    return per.unionByName(tot.select(F.lit(None).cast("long").alias("conv_id"), "accuracy"))


@register("token_totals", oracle=f"""
WITH {_EST_SQL}
SELECT CAST(conv_id AS VARCHAR) AS conversation, estimated_tokens, actual_tokens FROM cmp
UNION ALL
SELECT 'Total', CAST(sum(estimated_tokens) AS BIGINT), CAST(sum(actual_tokens) AS BIGINT) FROM cmp
""")
def token_totals(spark, sf_dir):
    return TK.with_total(_cmp(spark, sf_dir), "conv_id")


@register("token_melt", oracle=f"""
WITH {_EST_SQL}
SELECT conv_id AS conversation, 'estimated_tokens' AS type, estimated_tokens AS token_count FROM cmp
UNION ALL
SELECT conv_id, 'actual_tokens', actual_tokens FROM cmp
""")
def token_melt(spark, sf_dir):
    return TK.melt(_cmp(spark, sf_dir), "conv_id")


@register("usage_extract", oracle="""
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id % 60 AS VARCHAR) END AS remaining_requests,
       CASE WHEN event_type <> 'error' AND event_id % 2 = 0 THEN CAST(event_id % 900 AS VARCHAR) END AS remaining_tokens,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS prompt_tokens,
       NULL::BIGINT AS completion_tokens, CAST(json_extract_string(props, '$.k') AS BIGINT) AS total_tokens
FROM events
""")
def usage_extract(spark, sf_dir):
    """events.props is the response body; its ``k`` field plays the prompt-token usage. Failed
    calls come without headers, every other call without the token header."""
    ev = Tables(spark, sf_dir).events.select("event_id", "props", "event_type", "user_id")
    requests = F.create_map(F.lit("x-ratelimit-remaining-requests"), (F.col("user_id") % 60).cast("string"))
    left = F.create_map(F.lit("x-ratelimit-remaining-tokens"), (F.col("event_id") % 900).cast("string"))
    headers = F.when(F.col("event_type") != "error", F.when(F.col("event_id") % 2 == 0, F.map_concat(requests, left)).otherwise(requests))
    body = F.concat(F.lit('{"usage": {"prompt_tokens": '), F.get_json_object("props", "$.k"),
                    F.lit(', "total_tokens": '), F.get_json_object("props", "$.k"), F.lit("}}"))
    return ev.select("event_id", *TK.usage_fields(body, headers))


@register("image_parts", oracle="""
WITH img AS (SELECT conv_id, turn, 'conv/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) || '.png' AS url
             FROM conversations WHERE role = 'user')
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS INTEGER) AS rank, url,
       NULL::VARCHAR AS error FROM img
UNION ALL
SELECT DISTINCT conv_id, NULL::INTEGER, NULL::VARCHAR, 'no images found' FROM conversations
WHERE conv_id NOT IN (SELECT conv_id FROM img)
""")
def image_parts(spark, sf_dir):
    """User turns carry a page image; collect them newest first."""
    c = _conv(spark, sf_dir)
    url = F.when(F.col("role") == "user", F.concat(F.lit("conv/"), F.col("conv_id").cast("string"), F.lit("/"),
                                                   F.col("turn").cast("string"), F.lit(".png")))
    return M.image_parts_newest_first(c.withColumn("url", url), "conv_id", "turn", "url")
