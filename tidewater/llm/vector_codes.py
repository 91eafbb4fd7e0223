"""Vector codes: four codebooks of 256 entries, learned in rounds, with an exact nearest search.

Components are integers, so distances, sums and codebooks are exact and the same for any
partitioning. The nearest entry of a part is found by slice and intersect: per dimension the
entries' coordinates are sorted, and each place in that order carries a mask of the entries
before it, packed in uint64 words. The entries inside a radius of a coordinate are then a slice
of the order, its mask the difference of two prefix masks; the AND over the dimensions leaves
the entries inside a box. An initial radius gives a first candidate; the box of its distance
holds every entry that can be as near, so the best of those candidates is the nearest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import table, written
from tidewater.llm.registry import register

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SAFE = 1 << 27          # below this size of components 64-bit sums of squares can't overflow
BLOCK = 1024            # vectors searched together
MAX_LONG = (1 << 63) - 1


def to_integers(values: np.ndarray) -> np.ndarray:
    """floor(1024 * x) of finite doubles: int64, or Python integers where one is large."""
    if not values.size or np.abs(values).max() < SAFE / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    whole = [int(v) * SCALE if abs(v) >= 1 << 53 else math.floor(v * SCALE) for v in values.ravel().tolist()]
    return np.array(whole, object).reshape(values.shape)


def _roots(squares: np.ndarray) -> np.ndarray:
    """Floors of square roots."""
    if squares.dtype == object:
        return np.array([math.isqrt(int(s)) for s in squares], object)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


class SliceIndex:
    """The nearest of some entries (rows of integers) to each of many vectors, ties to the lower index."""

    def __init__(self, entries: np.ndarray):
        if entries.dtype == object or entries.size and np.abs(entries).max() >= SAFE:
            entries = entries.astype(object)
        self.entries, (self.n, self.width) = entries, entries.shape
        self.words = -(-self.n // 64)
        self.largest = int(np.abs(entries).max()) if entries.size else 0
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = [entries[order[:, d], d] for d in range(self.width)]
        bits = np.zeros((self.n, self.words), np.uint64)
        bits[np.arange(self.n), np.arange(self.n) // 64] = np.uint64(1) << (np.arange(self.n) % 64).astype(np.uint64)
        self.prefix = []  # per dimension: masks of the first 0, 1, .. n entries in coordinate order
        for d in range(self.width):
            masks = np.zeros((self.n + 1, self.words), np.uint64)
            np.bitwise_or.accumulate(bits[order[:, d]], axis=0, out=masks[1:])
            self.prefix.append(masks)
        # The initial radius: half the median distance between entries that follow each other.
        # It only decides how often a first box is empty.
        gaps = np.abs(entries[1:] - entries[:-1]) if self.n > 1 and self.width else np.zeros((1, 1), np.int64)
        self.radius = max(1, int(sorted(gaps.max(axis=1).tolist())[len(gaps) // 2]) // 2)

    def box(self, vectors: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per vector the mask of the entries within ``radius`` of it in every dimension."""
        mask = np.zeros((len(vectors), self.words), np.uint64)
        mask[:] = self.all_entries()
        for d in range(self.width):
            x, line = vectors[:, d], self.sorted[d]
            low, high = np.searchsorted(line, x - radius, "left"), np.searchsorted(line, x + radius, "right")
            mask &= self.prefix[d][high] ^ self.prefix[d][low]
        return mask

    def all_entries(self) -> np.ndarray:
        full = np.full(self.words, ~np.uint64(0))
        if self.n % 64:
            full[-1] = (np.uint64(1) << np.uint64(self.n % 64)) - np.uint64(1)
        return full

    def _best(self, vectors: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each vector's best candidate; entry -1 where it has none."""
        entries = self.entries.astype(vectors.dtype, copy=False)
        bits = np.unpackbits(mask.view(np.uint8).reshape(len(mask), 8 * self.words), axis=1, bitorder="little")[:, :self.n]
        who, entry = np.nonzero(bits)
        best = np.full(len(vectors), -1, np.int64)
        distance = np.zeros(len(vectors), vectors.dtype)
        if len(who):
            diff = np.take(vectors, who, axis=0) - np.take(entries, entry, axis=0)
            squares = (diff * diff).sum(axis=1) if diff.dtype == object else np.einsum("ij,ij->i", diff, diff)
            first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            least = np.minimum.reduceat(squares, first)
            some = who[first]
            distance[some] = least
            hit = np.flatnonzero(squares == np.repeat(least, np.diff(np.append(first, len(who)))))
            tied = who[hit]
            best[tied[::-1]] = entry[hit[::-1]]  # the lowest entry is written last
        return best, distance

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) per vector."""
        if vectors.dtype == object or self.entries.dtype == object or vectors.size and np.abs(vectors).max() >= SAFE:
            vectors = vectors.astype(object)
        elif vectors.size and self.width * (int(np.abs(vectors).max()) + self.largest) ** 2 < 1 << 31:
            vectors = vectors.astype(np.int32)  # no sum of squares leaves 32 bits
        best = np.empty(len(vectors), np.int64)
        distance = np.zeros(len(vectors), vectors.dtype)
        for at in range(0, len(vectors), BLOCK):
            block = vectors[at:at + BLOCK]
            radius = np.full(len(block), self.radius, vectors.dtype)
            todo, got, dist = np.arange(len(block)), np.full(len(block), -1, np.int64), np.zeros(len(block), vectors.dtype)
            for wider in (4, None):  # until every vector has a candidate: at last, the box that holds entry 0
                got[todo], dist[todo] = self._best(block[todo], self.box(block[todo], radius[todo]))
                todo = todo[got[todo] < 0]
                diff = block[todo] - self.entries[0]
                radius[todo] = radius[todo] * wider if wider else _roots((diff * diff).sum(axis=1)) + 1
            got[todo], dist[todo] = self._best(block[todo], self.box(block[todo], radius[todo]))
            again = np.flatnonzero(_roots(dist) > radius)  # something outside the box may be as near
            got[again], dist[again] = self._best(block[again], self.box(block[again], _roots(dist[again])))
            best[at:at + BLOCK], distance[at:at + BLOCK] = got, dist
        return best, distance


def kept_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``vector`` (doubles), ``label`` of the rows whose vector is not null and holds finite numbers only."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(vector.isNotNull() & finite).select(F.col(id_col).alias("vec_id"), vector.alias("vector"), F.col(label_col).alias("label"))


def padded_width(kept: DataFrame) -> int:
    """Components of the longest vector, rounded up to a multiple of PARTS."""
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    return -(-longest // PARTS) * PARTS


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of doubles as rows of ``width``, shorter ones ending in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes] or [np.zeros(0, int)]).astype(int)] = values
    return out


def _parts(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    column = batch.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    integers = to_integers(_matrix(column, width))
    step = width // PARTS
    return [integers[:, p * step:(p + 1) * step] for p in range(PARTS)]


class _Sums:
    """Exact sums and counts per entry of one part."""

    def __init__(self, entries: int, width: int):
        self.count, self.total = [0] * entries, np.zeros((entries, width), object)

    def add(self, codes: np.ndarray, vectors: np.ndarray) -> None:
        if not len(codes):
            return
        order = np.argsort(codes, kind="stable")
        ordered = codes[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        if vectors.shape[1]:
            self.total[ordered[first]] += np.add.reduceat(vectors[order], first, axis=0).astype(object)
        for entry, n in zip(ordered[first].tolist(), np.diff(np.append(first, len(codes))).tolist()):
            self.count[entry] += n


def _add_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds rows of equal (part, entry), which have met in this task, as they stream by."""
    totals: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for batch in batches:
        for part, entry, n, total in zip(batch["part"], batch["entry"], batch["n"], batch["total"]):
            before = totals.get((part, entry))
            own = [int(t) for t in total]
            totals[part, entry] = (n, own) if before is None else (before[0] + n, [x + y for x, y in zip(before[1], own)])
    yield pd.DataFrame([(*key, n, [str(t) for t in total]) for key, (n, total) in totals.items()], columns=["part", "entry", "n", "total"])


SUMS = "part int, entry int, n long, total array<string>"


def update_codebooks(kept: DataFrame, codebooks: list[np.ndarray], width: int) -> list[np.ndarray]:
    """One round: each entry becomes the floor of the mean of the parts that are nearest to it.

    A task sums its own rows first (at most PARTS x ENTRIES sums, whatever its input), those
    are added per entry; what reaches the driver is one row per entry."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [SliceIndex(c) for c in codebooks]
        sums = [_Sums(*c.shape) for c in codebooks]
        for batch in batches:
            for p, vectors in enumerate(_parts(batch, width)):
                sums[p].add(index[p].nearest(vectors)[0], vectors)
        rows = [(p, e, n, [str(t) for t in s.total[e]]) for p, s in enumerate(sums) for e, n in enumerate(s.count) if n]
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                                          pa.array(columns[3], pa.list_(pa.string()))], names=["part", "entry", "n", "total"])

    sums = kept.select("vector").mapInArrow(partial, SUMS).repartition("part", "entry").mapInPandas(_add_sums, SUMS)
    new = [c.astype(object) for c in codebooks]
    for r in sums.collect():  # at most PARTS x ENTRIES rows
        new[r.part][r.entry] = [int(t) // r.n for t in r.total]
    return [c.astype(np.int64) if c.size == 0 or max(map(abs, c.ravel().tolist())) < SAFE else c for c in new]


def fit_codebooks(kept: DataFrame, width: int, rounds: int = ROUNDS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The codebooks after ``rounds`` rounds over all rows of ``kept``. They start as the parts of the
    ``entries`` rows with the smallest ids (null ids last, equal ids by vector); fewer rows give
    fewer entries, none gives empty codebooks."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = np.zeros((len(first), width))
    for k, r in enumerate(first):
        start[k, :len(r.vector)] = r.vector
    integers, step = to_integers(start), width // PARTS
    books = [integers[:, p * step:(p + 1) * step] for p in range(PARTS)]
    for _ in range(rounds if first else 0):
        books = update_codebooks(kept, books, width)
    return books


def encode_vectors(kept: DataFrame, codebooks: list[np.ndarray], width: int) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` (squared distances, summed
    over the parts; one beyond a long is given as the greatest long) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [SliceIndex(c) for c in codebooks]
        for batch in batches:
            code, error = np.zeros((batch.num_rows, PARTS), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, vectors in enumerate(_parts(batch, width)):
                best, distance = index[p].nearest(vectors)
                code[:, p] = best
                error = error + distance
            if error.dtype == object:
                error = np.array([min(int(e), MAX_LONG) for e in error], np.int64)
            text = code.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([text[2 * PARTS * k:2 * PARTS * (k + 1)] for k in range(len(code))], pa.string()),
                 pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return kept.select("vec_id", "label", "vector").mapInArrow(run, schema)


def decode_codes(coded: DataFrame, codebooks: list[np.ndarray], code_col: str = "code") -> DataFrame:
    """``coded`` plus ``approximate``: the vector that each code stands for, in the original scale.
    Columns of ``coded`` stay; one named ``approximate`` is replaced."""
    books = [[[int(x) / SCALE for x in entry] for entry in book] for book in codebooks]

    @F.pandas_udf("array<double>")
    def vector(code: pd.Series) -> pd.Series:
        return code.map(lambda c: None if c is None else [x for p in range(PARTS) for x in books[p][int(c[2 * p:2 * p + 2], 16)]])
    return coded.withColumn("approximate", vector(F.col(code_col)))


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def compress_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Codes of all vectors of ``rows`` by codebooks learned from all of them: ``vec_id``, ``code``,
    ``error``, ``label_error`` (error summed over equal labels, null labels together; beyond a long
    the greatest long) and ``codebooks_sha256``.

    Rows with a null vector or null or non-finite components take no part. Repeated rows and ids stay.
    A vector shorter than the longest, rounded up to a multiple of four, counts as ending in
    zeros. Components of any finite size are handled exactly. An empty table gives an empty result.
    Other columns of ``rows`` don't matter, whatever their names."""
    kept = written(kept_vectors(rows, id_col, vector_col, label_col), "vectors")
    width = padded_width(kept)
    books = fit_codebooks(kept, width)
    coded = written(encode_vectors(kept, books, width), "codes")
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.least(exact, F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


@register("op12_vector_codes")
def op12_vector_codes(spark, sf_dir):
    return compress_vectors(table(spark, sf_dir, "embeddings"))
