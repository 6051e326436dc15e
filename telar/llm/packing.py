"""Documents packed into containers of fixed capacity by the sum-of-squares rule.

A document goes where the sum, over all levels, of the squared numbers of open containers becomes smallest. That keeps
the levels evenly spread, so that nearly every size meets a container it fills. The rule looks only at the counts per
level, an array as long as the capacity, and is one vector operation a document.

The rule is sequential; the corpus is cut into blocks of about ``block`` documents by a hash of the key, each packed on
its own, so that tasks are equal and bounded whatever the data. A block wastes at most a few open containers.

Defined results: a document of size 0 or null is in no container; one longer than the capacity is cut into full
containers and a rest, which is packed like a document; no other is cut; repeated keys count as separate documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
BLOCK = 40_000


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item, 0.. in order of opening; items come in decreasing size."""
    order = np.argsort(-sizes, kind="stable")
    counts = np.zeros(capacity + 1)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    n = 0
    shut = np.full(capacity + 1, np.inf)  # shut[h]: cost of taking a container from level h; inf where there is none
    for k in order:
        s = int(sizes[k])
        # From level h to h + s the sum changes by 2 (N[h+s] - N[h]) + 2; a full container leaves it, a new one joins it.
        cost = counts[s:] + shut[: capacity + 1 - s]
        cost[capacity - s] = shut[capacity - s] - 0.5
        h = int(np.argmin(cost))
        if cost[h] > counts[s] - (0 if s < capacity else 0.5) + 0.5 or not np.isfinite(cost[h]):
            h, c = 0, n
            n += 1
        else:
            c = open_[h].pop()
            counts[h] -= 1
            shut[h] = 1 - counts[h] if counts[h] else np.inf
        out[k] = c
        if h + s < capacity:
            open_[h + s].append(c)
            counts[h + s] += 1
            shut[h + s] = 1 - counts[h + s]
    return out


def packed(sizes: DataFrame, key: str, size: str, documents: int, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """(key, piece, tokens, container): ``documents`` is the number of rows, which sets the number of blocks."""
    blocks = max(1, -(-documents // block))
    full = F.floor(F.col(size) / capacity).cast("int")
    rest = F.col(size) - full * capacity
    pieces = F.concat(
        F.transform(F.sequence(F.lit(0), F.greatest(full - 1, F.lit(0))), lambda i: F.when(i < full, F.struct(i.alias("piece"), F.lit(capacity).alias("tokens")))),
        F.array(F.when(rest > 0, F.struct(full.alias("piece"), rest.cast("int").alias("tokens")))))
    rows = sizes.where(F.col(size) > 0).select(F.col(key), F.inline(F.array_compact(pieces)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(key, "piece"), F.lit(blocks)).cast("int"))
    kind = dict(sizes.dtypes)[key]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, "piece"], kind="stable")
        at = sum_of_squares(pdf["tokens"].to_numpy(), capacity)
        return pd.DataFrame({key: pdf[key], "piece": pdf["piece"], "tokens": pdf["tokens"], "container": (pdf["block"].to_numpy().astype(np.int64) << 32) + at})

    return rows.groupBy("block").applyInPandas(pack, f"`{key}` {kind}, piece int, tokens int, container bigint")
