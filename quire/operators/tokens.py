"""Token accounting.

The default counter is a JVM-side regex that splits text the way BPE
pre-tokenisers do (letter runs, digit runs, single punctuation marks);
``arrow_counter`` wraps any ``encode(str) -> list`` into an Arrow-batched
pandas UDF for an exact vocabulary when one is available offline.
Conversation totals are plain ``sum`` aggregates, so they combine
map-side and no conversation is ever gathered in one place.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import col_

TOKEN_PATTERN = r"\p{L}+|\p{N}+|[^ \t\n\r\f\p{L}\p{N}]"

# Message framing per model (tokens per message, tokens per name).
DEFAULT_MODEL = "gpt-4-32k-0314"
TOKENS_PER_MESSAGE = {
    "gpt-3.5-turbo-0613": 3,
    "gpt-3.5-turbo-16k-0613": 3,
    "gpt-4-0314": 3,
    "gpt-4-32k-0314": 3,
    "gpt-4-0613": 3,
    "gpt-4-32k-0613": 3,
    "gpt-3.5-turbo-0301": 4,
}
TOKENS_PER_NAME = {"gpt-3.5-turbo-0301": -1}
FUNCTION_CALL_TOKENS = 9
REPLY_PRIMING_TOKENS = 3


def regex_tokens(text) -> Column:
    """A12 default: number of pre-tokens of the whole text (0 for null)."""
    return F.coalesce(F.size(F.regexp_extract_all(col_(text), F.lit(TOKEN_PATTERN), 0)), F.lit(0))


def arrow_counter(encode: Callable[[str], list]):
    """Exact counter hook: ``encode`` runs on Arrow batches inside executors."""
    @F.pandas_udf("long")
    def count(s: pd.Series) -> pd.Series:
        return s.map(lambda t: 0 if t is None else len(encode(t))).astype("int64")
    return count


def message_tokens(role, content, name=None, model: str = DEFAULT_MODEL,
                   counter=regex_tokens) -> Column:
    """Per-message estimate: framing + tokens(role) + tokens(content) [+ tokens(name) + per-name]."""
    per_msg = TOKENS_PER_MESSAGE.get(model, 3)
    per_name = TOKENS_PER_NAME.get(model, 1)
    total = F.lit(per_msg) + counter(role) + counter(content)
    if name is not None:
        total = total + F.when(col_(name).isNotNull(), counter(name) + F.lit(per_name)).otherwise(0)
    return total


def estimate_conversations(conv: DataFrame, key: str = "conv_id", role: str = "role",
                           content: str = "text", name: str | None = None,
                           model: str = DEFAULT_MODEL, has_function_call: bool = False,
                           counter=regex_tokens) -> DataFrame:
    """(key, estimated_tokens) = Σ per-message estimate + 3 (+9 with a function call)."""
    extra = REPLY_PRIMING_TOKENS + (FUNCTION_CALL_TOKENS if has_function_call else 0)
    per = message_tokens(role, content, name, model, counter)
    return conv.groupBy(key).agg((F.sum(per) + F.lit(extra)).cast("long").alias("estimated_tokens"))


def compare(estimates: DataFrame, actuals: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Estimate vs actual for successful calls only (status = 200)."""
    ok = actuals.filter(F.col(status) == 200).select(key, "actual_tokens")
    return estimates.join(ok, key)


def accuracy(est: Column, act: Column) -> Column:
    """Est / act * 100, 0 when act <= 0."""
    return F.when(act > 0, est.cast("double") / act * 100).otherwise(F.lit(0.0))


def with_total(cmp: DataFrame, key: str, label: str = "Total") -> DataFrame:
    """Per-key rows plus one total row, from one ``rollup``."""
    r = cmp.rollup(key).agg(F.sum("estimated_tokens").cast("long").alias("estimated_tokens"),
                            F.sum("actual_tokens").cast("long").alias("actual_tokens"),
                            F.grouping(key).alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(key).cast("string"))
                    .alias("conversation"), "estimated_tokens", "actual_tokens")


def melt(cmp: DataFrame, key: str) -> DataFrame:
    """Wide -> long (conversation, type, token_count)."""
    return cmp.select(key, "estimated_tokens", "actual_tokens").unpivot(
        [key], ["estimated_tokens", "actual_tokens"], "type", "token_count"
    ).withColumnRenamed(key, "conversation")


def usage_fields(body_json, headers_map=None) -> list[Column]:
    """Rate-limit headers + usage token counts; missing -> null, header values stay strings."""
    b = col_(body_json)
    out = []
    for h in ("x-ratelimit-remaining-requests", "x-ratelimit-remaining-tokens"):
        v = F.try_element_at(headers_map, F.lit(h)) if headers_map is not None else F.lit(None).cast("string")
        out.append(v.alias(h.replace("x-ratelimit-", "").replace("-", "_")))
    for k in ("prompt_tokens", "completion_tokens", "total_tokens"):
        out.append(F.get_json_object(b, f"$.usage.{k}").try_cast("long").alias(k))
    return out
