"""What the numpy-trained models share: bounded samples and Adam."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Groups that a sample tells apart at most: they are collected, with their counts.
MOST_GROUPS = 1000


def bounded_sample(df: DataFrame, group: Column, doc_id: Column, most: int) -> DataFrame:
    """About most rows of each group, by a hash of the id and the row's place; all rows
    of a smaller one. Rows that share an id, or have none, are drawn one by one.

    The kept share follows from each group's count, so the sample has a bound and
    needs no sort. Groups are the classes of a label; of more than MOST_GROUPS the
    largest are taken.
    """
    tagged = df.withColumn("_group", group.cast("string"))
    counts = tagged.groupBy("_group").count().filter("_group IS NOT NULL").orderBy(F.desc("count"), "_group").limit(MOST_GROUPS).collect()
    if not counts:
        return tagged.filter(F.lit(False))
    limits = F.create_map(*[F.lit(x) for r in counts for x in (r["_group"], min(1.0, most / r["count"]))])
    place = F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.monotonically_increasing_id(), F.lit(7))
    return tagged.withColumn("_spot", F.pmod(place, F.lit(1 << 30)) / float(1 << 30)).filter(F.col("_spot") < F.try_element_at(limits, F.col("_group"))).drop("_spot")


class Adam:
    """Adam on a list of arrays, updated in place; rows(...) updates some rows only."""

    def __init__(self, params: list[np.ndarray], rate: float = 0.01):
        self.params, self.rate, self.t = params, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def tick(self) -> None:
        self.t += 1

    def step(self, i: int, grad: np.ndarray, rows=slice(None)) -> None:
        m = self.m[i][rows] = 0.9 * self.m[i][rows] + 0.1 * grad
        v = self.v[i][rows] = 0.99 * self.v[i][rows] + 0.01 * grad * grad
        fix = np.sqrt(1 - 0.99**self.t) / (1 - 0.9**self.t)
        self.params[i][rows] -= (self.rate * fix * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)
