"""Small tables with the hard rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the and of to in that is was for with on as by this are from or an be it".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split()


def prose(rng: random.Random, words: list[str], n: int) -> str:
    out = [rng.choice(words) if rng.random() < 0.5 else "".join(rng.choice(words) for _ in range(2)) for _ in range(n)]
    return "\n".join(" ".join(out[i:i + 12]) + "." for i in range(0, n, 12))


def documents(seed: int = 0, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, words = ("en", EN) if i % 3 else ("de", DE)
        rows.append((i, prose(rng, words, rng.randint(20, 160)), lang, f"s{i % 4}", None))
    rows.append((n, rows[1][1], "en", "s0", 5))  # exact copy
    rows.append((n + 1, rows[2][1].replace("the", "thee", 1), "en", "s0", 5))  # near copy
    rows += [(n + 2, None, "en", None, None), (n + 3, "", None, "s1", 0), (n + 4, "  \n\t ", "en", "s9", 0), (n + 5, "12 34!", "de", None, 0)]
    rows.append((n + 6, prose(rng, EN, 6000), "en", "s2", None))  # very long
    rows += [(None, "an orphan text of no id", None, None, None), (3, rows[3][1], "de", "s3", None), (3, rows[3][1], "de", "s3", None)]
    return rows


def frame(spark, rows, schema: str = SCHEMA):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """``df`` with extra columns that helpers could trip over."""
    from pyspark.sql import functions as F

    return df.select("*", F.lit(1).alias("score"), F.lit("x").alias("id"), F.lit(2.0).alias("a.b"), F.lit(3).alias("_target"), F.lit(4).alias("n"), F.lit(5).alias("size"))
