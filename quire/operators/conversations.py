"""Chat messages, streamed replies and page-text assembly.

Conversation rows are ``(conv_id, turn, role, text)``. Where a result is a
per-conversation *value* (last turn, counts, flags) it is computed with
partial aggregates (``max_by``, ``count``, ``sum``) that combine map-side,
so a conversation holding a third of all rows still ships one small row
per map task. Long texts per key (a document's pages, a reply's deltas, a
request body) come in parts of ``PART_ROWS`` rows, ``(key, part_no, text)``:
the parts in order, put together, are the text, and no group is ever larger
than a part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.sampling import bucketed_rank

#: Rows of one part of a long text.
PART_ROWS = 256
#: Width of the order-column ranges that rank a key's rows in parallel.
RANK_RANGE = 1024

MSG = "struct<role:string,content:string>"


def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    c = F.lit(content) if isinstance(content, str) else content
    return F.struct(r.cast("string").alias("role"), c.cast("string").alias("content"))


def ordered_texts(order_col: str, value: Column) -> Column:
    """Aggregate: values of a group sorted by ``order_col`` (ARRAY)."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                            value.alias("v")))),
                       lambda x: x["v"])


def split_last_turn(conv: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """(key, history ARRAY<message>, prompt STRING): the last turn is the new request.

    One aggregation: the ordered turn list, split into all-but-last and last.
    For requests that are one value by nature; ``messages_long`` and
    ``body_parts`` give the same messages without gathering a conversation.
    """
    arr = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                               message(F.col("role"), F.col("text")).alias("m"))))
    return (conv.groupBy(key).agg(arr.alias("_a"))
            .select(key,
                    F.transform(F.slice("_a", 1, F.size("_a") - 1), lambda x: x["m"]).alias("history"),
                    F.element_at("_a", -1)["m"]["content"].alias("prompt")))


def messages_async(req: DataFrame, system_prompt: str) -> DataFrame:
    """History, then the system message, then the user prompt."""
    return req.withColumn("messages", F.concat(
        F.coalesce("history", F.array().cast(f"array<{MSG}>")),
        F.array(message("system", system_prompt), message("user", F.col("prompt")))))


def messages_sync(req: DataFrame, system_prompt: str) -> DataFrame:
    """Prepend the system message unless the history already starts with it."""
    sys_msg = message("system", system_prompt)
    h = F.coalesce("history", F.array().cast(f"array<{MSG}>"))
    first = F.get(h, 0)  # null on empty, never raises
    with_sys = F.when(F.coalesce(first == sys_msg, F.lit(False)), h).otherwise(
        F.concat(F.array(sys_msg), h))
    return req.withColumn("messages", F.concat(with_sys, F.array(message("user", F.col("prompt")))))


def append_reply(df: DataFrame, prompt_col: str, reply_col: str, reply_role: str = "system") -> DataFrame:
    """After a reply, history += user prompt, reply (stored with ``reply_role``)."""
    return df.withColumn("messages", F.concat(
        "messages", F.array(message("user", F.col(prompt_col)), message(reply_role, F.col(reply_col)))))


PART = "struct<type:string,text:string,url:string>"


def content_parts(text: Column, image_urls: Column, image_first: bool = False) -> Column:
    """ARRAY<STRUCT<type, text, url>>; chat puts text first, SLM/extraction image first."""
    tpart = F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                             F.lit(None).cast("string").alias("url")))
    iparts = F.transform(F.coalesce(image_urls, F.array().cast("array<string>")),
                         lambda u: F.struct(F.lit("image_url").alias("type"),
                                            F.lit(None).cast("string").alias("text"), u.alias("url")))
    return F.concat(iparts, tpart) if image_first else F.concat(tpart, iparts)


def messages_valid(messages: Column) -> Column:
    """Every message has role and content (non-null)."""
    return F.forall(F.coalesce(messages, F.array().cast(f"array<{MSG}>")),
                    lambda m: m["role"].isNotNull() & m["content"].isNotNull())


def conversations_valid(conv: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """P18 without building the message list, equal to ``messages_valid`` on the
    request: history turns need a role and content; the last turn becomes the
    user prompt (role 'user'), so only its content counts; the system message
    is always valid. Partial aggregates only (no conversation is gathered)."""
    bad = F.col("role").isNull() | F.col("text").isNull()
    per = conv.groupBy(key).agg(F.count_if(bad).alias("_bad"),
                                F.max_by(bad, order).alias("_last_bad"),
                                F.max_by(F.col("text").isNull(), order).alias("_last_empty"))
    hist_bad = F.col("_bad") - F.when(F.col("_last_bad"), 1).otherwise(0)
    return per.select(key, ((hist_bad == 0) & ~F.col("_last_empty")).alias("valid"))


def parts_valid(parts: Column) -> Column:
    """P18 for multimodal content: every part has a ``type`` or a ``text``."""
    return F.forall(F.coalesce(parts, F.array().cast(f"array<{PART}>")),
                    lambda p: p["type"].isNotNull() | p["text"].isNotNull())


def text_parts(rows: DataFrame, key: str, order: str, value: str, sep: str, out: str,
               part_rows: int = PART_ROWS) -> DataFrame:
    """(key, part_no, out): a key's non-null values in ``order``, joined by ``sep``.

    Every part joins up to ``part_rows`` values; a part after the first begins
    with ``sep``, so the parts of a key, put together in order, are its text.
    A key without any value has no part. ``order`` is numeric and unique in a key.
    """
    ranked = bucketed_rank(rows.filter(F.col(value).isNotNull()).select(key, order, value), [key], [F.col(order)],
                           F.floor(F.col(order) / F.lit(RANK_RANGE)), out="_r")
    parts = ranked.withColumn("part_no", F.floor(F.col("_r") / F.lit(part_rows)).cast("int"))
    joined = parts.groupBy(key, "part_no").agg(F.array_join(ordered_texts(order, F.col(value)), sep).alias("_t"))
    lead = F.when(F.col("part_no") == 0, F.lit("")).otherwise(F.lit(sep))
    return joined.select(key, "part_no", F.concat(lead, "_t").alias(out))


def assemble_deltas(deltas: DataFrame, key: str, order: str, delta: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Reply text = ordered concatenation of non-null deltas, in parts."""
    return text_parts(deltas, key, order, delta, "", "reply", part_rows)


def last_turn_flag(conv: DataFrame, key: str, order: str, text: str,
                   analyse=lambda last: last, word: str = "yes") -> DataFrame:
    """Last message non-empty and the analyser's answer contains ``word`` (any case).

    ``analyse(last_text) -> Column`` stands for the analyser model's answer
    on the last turn. ``max_by`` combines map-side, so no conversation is
    gathered into one task.
    """
    last = conv.groupBy(key).agg(F.max_by(text, order).alias("last_text"))
    ans = analyse(F.col("last_text"))
    flag = (F.coalesce(F.length("last_text") > 0, F.lit(False))
            & F.coalesce(F.lower(ans).contains(word.lower()), F.lit(False)))
    return last.select(key, "last_text", flag.alias("wants_image"))


def join_pages(pages: DataFrame, key: str, page_col: str, text_col: str, sep: str = "\n",
               part_rows: int = PART_ROWS) -> DataFrame:
    """Document text = page texts joined by ``sep`` in page order, in parts."""
    return text_parts(pages, key, page_col, text_col, sep, "text", part_rows)


def page_count(pages: DataFrame, key: str, page_col: str, meta_cols: Sequence[str]) -> DataFrame:
    """Pages per document plus document-level metadata taken from the first page."""
    return pages.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_pages"),
        *[F.min_by(c, page_col).alias(c) for c in meta_cols])


def page_names(df: DataFrame, stem: Column, page_no: Column) -> Column:
    """``<stem>-page-<n>.png`` (n from 1)."""
    return F.concat(stem, F.lit("-page-"), page_no.cast("string"), F.lit(".png"))


def parse_page_ranges(spec: str) -> list[tuple[int, int]]:
    """P5 (driver side, parameter only): '1-3,5,7-9' -> [(1,3),(5,5),(7,9)]."""
    out = []
    for part in spec.split(","):
        part = part.strip()
        if not part:
            continue
        lo, _, hi = part.partition("-")
        lo_i = int(lo)
        hi_i = int(hi) if hi else lo_i
        if lo_i < 1 or hi_i < lo_i:
            raise ValueError(f"bad page range {part!r}")
        out.append((lo_i, hi_i))
    return out


def select_pages(df: DataFrame, page_col: Column, spec: str) -> DataFrame:
    """P5: keep rows whose 1-based page number is in the selector.

    The selector becomes a disjunction of range predicates — a filter that
    needs no join and can be pushed into the scan.
    """
    cond = F.lit(False)
    for lo, hi in parse_page_ranges(spec):
        cond = cond | page_col.between(lo, hi)
    return df.filter(cond)


def request_body(messages: Column, temperature: float = 0.0, max_tokens: int = 4000,
                 top_p: float = 0.95) -> Column:
    """P20: JSON request body with fixed sampling parameters."""
    return F.to_json(F.struct(messages.alias("messages"), F.lit(temperature).alias("temperature"),
                              F.lit(max_tokens).alias("max_tokens"), F.lit(top_p).alias("top_p")))


def body_parts(messages: DataFrame, key: str, temperature: float = 0.0, max_tokens: int = 4000,
               top_p: float = 0.95, part_rows: int = PART_ROWS) -> DataFrame:
    """P20 without gathering a conversation: (key, part_no, body) from long-form
    messages (key, pos, role, content); the parts of a key, put together in
    order, are the JSON request body of ``request_body``."""
    rows = messages.select(key, "pos", F.floor(F.col("pos") / F.lit(part_rows)).cast("int").alias("part_no"),
                           F.to_json(F.struct("role", "content")).alias("_m"))
    parts = rows.groupBy(key, "part_no").agg(F.array_join(ordered_texts("pos", F.col("_m")), ",").alias("_t"))
    last = messages.groupBy(key).agg(F.floor(F.max("pos") / F.lit(part_rows)).cast("int").alias("_last"))
    settings = F.to_json(F.struct(F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_tokens"),
                                  F.lit(top_p).alias("top_p")))
    lead = F.when(F.col("part_no") == 0, F.lit('{"messages":[')).otherwise(F.lit(","))
    tail = F.when(F.col("part_no") == F.col("_last"), F.concat(F.lit("],"), F.substring(settings, 2, 1 << 20))).otherwise(F.lit(""))
    return parts.join(last, key).select(key, "part_no", F.concat(lead, "_t", tail).alias("body"))


def image_parts_newest_first(parts: DataFrame, key: str, order: str, url: str,
                             bucket_width: int = RANK_RANGE) -> DataFrame:
    """Image parts of a conversation, newest message first (rank from 1);
    a conversation without any image gets one row with an error.

    The newest-first rank is a ``bucketed_rank`` over turn ranges, so even a
    conversation holding a third of all rows is ranked by many tasks.
    """
    imgs = parts.filter(F.col(url).isNotNull()).select(key, order, url)
    ranked = bucketed_rank(imgs, [key], [F.col(order).desc()],
                           F.floor(-F.col(order) / F.lit(bucket_width)), out="_r")
    ranked = ranked.select(key, (F.col("_r") + 1).cast("int").alias("rank"), F.col(url).alias("url"),
                           F.lit(None).cast("string").alias("error"))
    none = (parts.select(key).distinct().join(imgs.select(key), key, "left_anti")
            .select(key, F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("url"),
                    F.lit("no images found").alias("error")))
    return ranked.unionByName(none)


def messages_long(conv: DataFrame, system_prompt: str, mode: str = "async", key: str = "conv_id",
                  order: str = "turn", reply: Column | None = None, reply_role: str = "system",
                  bucket_width: int = 1024) -> DataFrame:
    """P14 / P15 / P16 in long form: (key, pos, role, content), one row per message.

    The same messages as ``messages_async`` / ``messages_sync`` (+
    ``append_reply`` when ``reply`` is given, a Column over the prompt) but
    never gathered per conversation: the last turn and the first history
    message are partial aggregates (``max``, ``min_by``), and history
    positions come from ``bucketed_rank`` over turn ranges, so a
    conversation holding a third of all rows is spread over many tasks.
    """
    if mode not in ("async", "sync"):
        raise ValueError(f"unknown mode {mode!r}")
    per = conv.groupBy(key).agg(
        F.max(order).alias("_last"), F.count(F.lit(1)).alias("_n"),
        F.min_by(F.struct(F.col("role").alias("r"), F.col("text").alias("t")), order).alias("_first"))
    c = conv.join(per, key)  # one row per key on the right: AQE splits a hot key's side
    hist = c.filter(F.col(order) < F.col("_last"))
    ranked = bucketed_rank(hist, [key], [F.col(order)], F.floor(F.col(order) / F.lit(bucket_width)), out="_p")
    n_hist = F.col("_n") - 1
    if mode == "sync":
        # the system message is prepended unless the history already starts with it
        keep_first = (n_hist > 0) & (F.col("_first.r") == "system") & (F.col("_first.t") == system_prompt)
        shift = F.when(keep_first, F.lit(0)).otherwise(F.lit(1))
    else:
        keep_first, shift = F.lit(False), F.lit(0)
    sys_pos = F.when(F.lit(mode == "sync"), F.lit(0)).otherwise(n_hist)
    user_pos = n_hist + shift + F.lit(1 if mode == "async" else 0)
    h = ranked.select(key, (F.col("_p") + shift).cast("int").alias("pos"), F.col("role"), F.col("text").alias("content"))
    last = c.filter(F.col(order) == F.col("_last"))
    s = (per.filter(~keep_first) if mode == "sync" else per).select(
        key, sys_pos.cast("int").alias("pos"), F.lit("system").alias("role"), F.lit(system_prompt).alias("content"))
    u = last.select(key, user_pos.cast("int").alias("pos"), F.lit("user").alias("role"), F.col("text").alias("content"))
    out = h.unionByName(s).unionByName(u)
    if reply is not None:
        extra = last.select(key, F.col("text").alias("prompt"), user_pos.alias("_u"))
        out = (out.unionByName(extra.select(key, (F.col("_u") + 1).cast("int").alias("pos"), F.lit("user").alias("role"),
                                            F.col("prompt").alias("content")))
               .unionByName(extra.select(key, (F.col("_u") + 2).cast("int").alias("pos"),
                                         F.lit(reply_role).alias("role"), reply.alias("content"))))
    return out
