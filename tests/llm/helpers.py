"""Small frames with the awkward cases: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
ODD_TEXTS = ["", " ", "  a", "a  b \n c", "a\n\n b", "it's 'S a'll\t\tx ", "<|endoftext|> x",
             "日本 語　x  １2３", "\x1c \x85 a\xa0 b", "naïve. Größe, ça!", "a" * 3000, " " * 300,
             "x\r\ny\x0bz", "end ", "\n"]
#: Names the operators use themselves.
CLASHING = ["id", "text_", "vec", "label", "fp", "node", "component_id", "kept_id", "score",
            "length", "part", "nth", "h", "_id", "sha1", "size", "payload", "digest", "line_no",
            "_own_fp", "own_fp", "kept_fp", "mixed_id", "low", "high", "root", "u", "c0", "c1",
            "n", "by", "upto", "conv", "copies", "dim", "x", "spans", "base", "terms", "lines",
            "weights", "index", "seq", "at", "d"]


def frame(spark, rows, schema: str, clashing: bool = True):
    """Rows (all columns nullable) plus a column for every clashing name."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    taken = set(df.columns)
    for k, name in enumerate(CLASHING if clashing else []):
        if name not in taken:
            df = df.withColumn(name, F.lit(k))
    return df


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(["stone", "river", "light", "under", "seven", "paper", "wind",
                                "north", "green", "quiet"]) + rng.choice(["", "s", "ly", ","])
                    for _ in range(words))
