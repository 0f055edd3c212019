"""CTC decoding: greedy as windows, beams as an Arrow function."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Order of equal scores: the first in the dictionary.


def steps(logits: DataFrame, sample: str = "sample") -> DataFrame:
    """sample, t, v, logit -> sample, t, idx (the best symbol), prob (its softmax)."""
    top = logits.groupBy(sample, "t").agg(F.max("logit").alias("m"), F.min(F.struct((-F.col("logit")).alias("n"), F.col("v"))).alias("b"), F.collect_list("logit").alias("ls"))
    e = F.aggregate("ls", F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - F.col("m").cast("double")))
    return top.select(sample, "t", F.col("b.v").alias("idx"), (F.lit(1.0) / e).alias("prob"))


def greedy(logits: DataFrame, dictionary: list[str], blank: int, sample: str = "sample") -> DataFrame:
    """sample, text, score: best symbols, repeats and blanks dropped; the score is the mean chance at the steps that
    stay. A symbol that the dictionary lacks gives no character but counts."""
    s = steps(logits, sample)
    w = Window.partitionBy(sample).orderBy("t")
    kept = s.withColumn("prev", F.lag("idx").over(w)).withColumn("keep", (F.col("idx") != blank) & (F.col("prev").isNull() | (F.col("prev") != F.col("idx"))))
    names = F.lit(dictionary)
    ch = F.coalesce(F.get(names, F.col("idx")), F.lit(""))
    out = kept.groupBy(sample).agg(F.array_sort(F.collect_list(F.when(F.col("keep"), F.struct("t", ch.alias("c"))))).alias("cs"), F.avg(F.when(F.col("keep"), F.col("prob"))).alias("score"))
    return out.select(sample, F.array_join(F.transform("cs", lambda c: c["c"]), "").alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _beams(logits: np.ndarray, dictionary: list[str], blank: int, width: int) -> tuple[str, float]:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    beams = [("", -1, 1.0)]  # text, last symbol, score
    for row in p:
        best = np.argsort(-row, kind="stable")[:width]
        grown = []
        for text, last, score in beams:
            for v in best.tolist():
                new = text
                if v != blank and v != last and 0 <= v < len(dictionary):
                    new += dictionary[v]
                grown.append((new, v, score * float(row[v])))
        beams = sorted(grown, key=lambda b: -b[2])[:width]
    return beams[0][0], beams[0][2]


def beam(logits: DataFrame, dictionary: list[str], blank: int, width: int = 5, column: str = "logits", sample: str = "sample") -> DataFrame:
    """sample, text, score from arrays of steps: the best `width` symbols of each step extend the best `width` texts;
    equal texts are not merged."""

    @F.pandas_udf("struct<text: string, score: double>")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [_beams(np.array([np.asarray(s, np.float64) for s in x]), dictionary, blank, width) for x in rows]
            yield pd.DataFrame(found, columns=["text", "score"])

    return logits.select(sample, decode(F.col(column)).alias("d")).select(sample, "d.*")


def arrays(logits: DataFrame, sample: str = "sample") -> DataFrame:
    """Long rows to one array of steps a sample."""
    per = logits.groupBy(sample, "t").agg(F.array_sort(F.collect_list(F.struct("v", "logit"))).alias("r"))
    per = per.groupBy(sample).agg(F.array_sort(F.collect_list(F.struct("t", F.transform("r", lambda x: x["logit"]).alias("l")))).alias("s"))
    return per.select(sample, F.transform("s", lambda x: x["l"]).alias("logits"))


def decode(logits: DataFrame, dictionary: list[str], blank: int, method: str = "greedy", text_type: str | None = None, most: int = 1, width: int = 5, sample: str = "sample") -> DataFrame:
    """Greedy or beam decoding; single characters are cut to `most`."""
    if method not in ("greedy", "beam"):
        raise ValueError(f"unknown method {method}")
    out = greedy(logits, dictionary, blank, sample) if method == "greedy" else beam(arrays(logits, sample), dictionary, blank, width, sample=sample)
    return out.withColumn("text", F.substr("text", F.lit(1), F.lit(most))) if text_type == "single_char" else out
