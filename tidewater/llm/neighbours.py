"""Approximate nearest neighbours by multi-index hashing.

Vectors get binary codes from learned rotations (iterative quantization of the principal
axes, fitted on a bounded sample). Codes are split into 16-bit substrings, each with an
index. Two codes within Hamming radius r agree in some substring up to r / substrings bits
(pigeonhole), so probing the substring indexes finds every code within r; those are
reranked by cosine on the original vectors in double precision.

The radius is calibrated on the sample to hold ``COVERAGE`` of its true neighbours. Queries
that find too few neighbours inside it are searched again with the radius that takes all.

Candidates are dealt to blocks; a task indexes one block and probes it with one block of
the stated queries. Only the best k per query leave a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import table, written
from tidewater.llm.registry import register

BITS = 256           # code length, in whole rotations of the vectors' dimension
SUBSTRING = 16
MAX_SAMPLE = 4000    # vectors the rotations and the radius are fitted on
COVERAGE = 0.99
BLOCK_ROWS = 8192
QUERY_ROWS = 2048


@dataclass
class Coder:
    mean: np.ndarray
    rotation: np.ndarray  # (dimension, bits)
    radius: int

    @property
    def bits(self) -> int:
        return self.rotation.shape[1]

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """(rows, bits / SUBSTRING) uint16 substrings of the codes of unit vectors."""
        on = (unit - self.mean) @ self.rotation > 0
        return np.packbits(on, axis=1).view(">u2").astype(np.uint16)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component below 1: cosines stay what they
    are to the last bit, and no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of code rows ``a`` to one code ``b``."""
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def fit_coder(sample: np.ndarray, k: int, bits: int = BITS, coverage: float = COVERAGE, seed: int = 7) -> Coder:
    """Rotations by iterative quantization: alternate codes and the rotation nearest to them."""
    rng = np.random.default_rng(seed)
    unit = unit_rows(scaled(sample))
    mean = unit.mean(axis=0)
    centred = unit - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:min(len(axes), bits)]
    projected = centred @ axes.T
    d = projected.shape[1]
    parts = []
    for _ in range(-(-bits // d)):
        r, _ = np.linalg.qr(rng.normal(size=(d, d)))
        for _ in range(30):
            u, _, vt = np.linalg.svd(np.where(projected @ r > 0, 1.0, -1.0).T @ projected)
            r = (u @ vt).T
        parts.append(axes.T @ r)
    rotation = np.hstack(parts)[:, :bits]
    if rotation.shape[1] < bits:
        rotation = np.hstack([rotation, np.zeros((rotation.shape[0], bits - rotation.shape[1]))])
    coder = Coder(mean, rotation, bits)
    codes, found = coder.codes(unit), []
    for q in range(min(len(unit), 600)):
        score = unit @ unit[q]
        score[q] = -2
        found += hamming(codes[np.argpartition(-score, min(k, len(unit) - 1))[:k]], codes[q]).tolist()
    coder.radius = int(np.quantile(found, coverage)) if len(unit) > 10 * k else bits
    return coder


class SubstringIndex:
    """Rows of a block by the value of each substring of their code."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.orders, self.values, self.starts = [], [], []
        for s in range(codes.shape[1]):
            order = np.argsort(codes[:, s], kind="stable")
            values, starts = np.unique(codes[order, s], return_index=True)
            self.orders.append(order)
            self.values.append(values)
            self.starts.append(np.append(starts, len(order)))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs from ``code`` in at most ``radius`` bits."""
        n, parts = self.codes.shape
        seen = np.zeros(n, bool)
        for s in range(parts):
            near = np.bitwise_count(self.values[s] ^ code[s]) <= radius // parts
            sizes = np.diff(self.starts[s])
            seen[self.orders[s][np.repeat(near, sizes)]] = True
        rows = np.flatnonzero(seen)
        return rows[hamming(self.codes[rows], code) <= radius]


FOUND = "query_row long, query_id long, row long, vec_id long, score double"


def best_in_block(rows: np.ndarray, ids: np.ndarray, x: np.ndarray, query_rows: np.ndarray, query_ids: np.ndarray, q: np.ndarray,
                  coder: Coder, radius: int, k: int) -> pd.DataFrame:
    x, q = scaled(x), scaled(q)
    index = SubstringIndex(coder.codes(unit_rows(x)))
    lengths, out = np.sqrt((x * x).sum(axis=1)), []
    for query_row, query, v, code in zip(query_rows, query_ids, q, coder.codes(unit_rows(q))):
        at = index.within(code, radius)
        at = at[rows[at] != query_row]
        score = x[at] @ v / (lengths[at] * np.sqrt(v @ v))
        best = np.lexsort((rows[at], ids[at], -score))[:k]
        out.append(pd.DataFrame({"query_row": query_row, "query_id": query, "row": rows[at][best], "vec_id": ids[at][best], "score": score[best]}))
    return pd.concat(out)


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, vec_id, v) of rows that take part: id and vector not null, all components finite, not all
    zero. ``row`` numbers them, so rows that repeat an id are told apart."""
    v = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")


def search(vectors: DataFrame, queries: DataFrame, coder: Coder, radius: int, k: int, n: int, n_queries: int) -> DataFrame:
    """Best k per query and block (FOUND)."""
    blocks, query_blocks = -(-n // BLOCK_ROWS) or 1, -(-n_queries // QUERY_ROWS) or 1
    left = (vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
            .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.withColumn("query_block", F.pmod(F.xxhash64("query_row"), F.lit(query_blocks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))

    def one(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_row": [], "query_id": [], "row": [], "vec_id": [], "score": []})
        return best_in_block(*(a[c].to_numpy(np.int64) for c in ("row", "vec_id")), np.stack(a["v"].to_numpy()).astype(np.float64),
                             *(b[c].to_numpy(np.int64) for c in ("query_row", "query_id")), np.stack(b["q"].to_numpy()).astype(np.float64),
                             coder, radius, k)

    return left.groupBy("block", "query_block").cogroup(right.groupBy("block", "query_block")).applyInPandas(one, FOUND)


def neighbours_of_one_dimension(vectors: DataFrame, queries: DataFrame, k: int, n: int, n_queries: int) -> DataFrame:
    """Best rows per query (FOUND, at least ``k`` or all there are) among vectors of one dimension."""
    share = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, MAX_SAMPLE / n) * (1 << 30)) + 1
    sample = vectors.where(share).orderBy("vec_id", "v").limit(MAX_SAMPLE).toPandas()["v"]
    if len(sample) < 2:
        sample = vectors.orderBy("vec_id", "v").limit(MAX_SAMPLE).toPandas()["v"]
    coder = fit_coder(np.stack(sample.to_numpy()).astype(np.float64), k)
    found = written(search(vectors, queries, coder, coder.radius, k, n, n_queries), "neighbours")
    short = queries.join(found.groupBy("query_row").agg(F.count("*").alias("m")), "query_row", "left").where(
        F.coalesce("m", F.lit(0)) < min(k, n - 1)).select("query_row", "query_id", "q")
    n_short = short.count()
    if n_short:
        rest = search(vectors, short, coder, coder.bits, k, n, n_short)
        found = found.join(short.select("query_row"), "query_row", "left_anti").unionByName(rest)
    return found


def nearest_neighbours(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``k`` nearest rows by cosine for every row where ``is_query`` (a condition on ``vec_id``)
    holds: query_id, rank, vec_id, score; nearest first, ties to the smaller id. Fewer rows only
    where there are fewer candidates. Rows that take part: see usable_vectors. Every such row of the
    query's dimension but the query's own is a candidate, so rows that repeat an id or a vector count
    each, and rows that repeat a query's id are queries of their own. Each dimension has its own codes
    and index. An empty table gives an empty result."""
    vectors = written(usable_vectors(df, id_col, vec_col).withColumn("d", F.size("v")), "vectors")
    sizes = vectors.groupBy("d").agg(F.count("*").alias("n"), F.count_if(is_query).alias("n_queries")).orderBy("d").collect()
    found = df.sparkSession.createDataFrame([], FOUND)
    for size in sizes:
        if size["n"] > 1 and size["n_queries"]:
            own = vectors.where(F.col("d") == size["d"]).drop("d")
            queries = own.where(is_query).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
            found = found.unionByName(neighbours_of_one_dimension(own, queries, k, size["n"], size["n_queries"]))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


@register("op6_nearest_neighbours")
def op6_nearest_neighbours(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
