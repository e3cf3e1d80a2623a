"""Exact top-k inner-product search by distributed histogram selection.

Queries and candidates meet in cells: queries are dealt into ``a`` groups and candidates into
``b`` groups by a hash of their ids, each query row goes to the b cells of its group and each
candidate row to the a cells of its group, so that every pair meets once and a cell holds a
bounded number of rows. A round scores each cell's pairs as one matrix product and sends, for
each query, counts of its scores by bin. Only a cell's highest bins that together hold k scores
are sent: a cell's kth best is never above the kth best of all. Spark sums the counts and finds
each query's bin with the kth value; the next round divides this bin further, until bins are
single scores. The last round keeps scores above the kth value and, of those equal to it, the
smallest ids, as many as are still needed from any cell.

Components become floor(64 * x). Vectors that are null, or hold a null, a value that is not finite or one that makes
no 64-bit component, and rows without an id take no part. Rows are told apart by a number of their own: of rows with equal ids each is a query
(if its id is) and a candidate of all others. Vectors of different lengths have no score, so a query of a length that no
other row has, like every query of an empty table, gives no rows; without queries there are none at all. Other columns don't matter. Scores are exact; one beyond
2**63 - 1 either way counts as that number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: bins of a round's histogram; it is sparse, with at most k entries from a cell for each query
BINS = 1 << 16
QUERY_GROUP, CANDIDATE_GROUP = 4096, 16_384
#: the largest score, and the type of sums and products of scores
MOST, WIDE = 2**63 - 1, "decimal(20,0)"


def int_vectors(rows: DataFrame, scale: int = 64) -> DataFrame:
    """(row, vec_id, v): whole-number vectors of the rows that take part, numbered."""
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < float(2**63)))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & whole)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<long>").alias("v"))


def _matrix(table: pa.Table, column: str = "v") -> np.ndarray:
    flat = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products; by floating point where no sum can lose a bit."""
    most_q, most_c = (max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) for x in (q, c))
    bound = most_q * most_c * q.shape[1]
    if bound < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T if bound <= MOST else _wide_scores(q, c)


def _wide_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of any 64-bit vectors, those beyond MOST cut to it.

    Vectors are split into four digits of 20 bits (the last is signed), products of digits are summed by weight as exact
    floating point numbers, and the sums are carried into digits again.
    """
    low = (1 << 20) - 1
    parts = [[(x >> 20 * k) & low if k < 3 else x >> 60 for k in range(4)] for x in (q, c)]
    digits, block = np.zeros((7, len(q), len(c)), np.int64), 1 << 10
    for i in range(4):
        for j in range(4):
            for d in range(0, q.shape[1], block):  # sums of at most block products of 40 bits
                digits[i + j] += (parts[0][i][:, d : d + block].astype(np.float64) @ parts[1][j][:, d : d + block].T.astype(np.float64)).astype(np.int64)
    for k in range(6):
        digits[k + 1] += digits[k] >> 20
        digits[k] &= low
    middle, top = digits[3] | digits[4] << 20 | digits[5] << 40, digits[6]
    small, negative = (top == 0) & (middle < 8), (top == -1) & (middle >= (1 << 60) - 8)
    value = digits[0] | digits[1] << 20 | digits[2] << 40 | (middle & 15) << 60
    return np.where(small | negative, np.maximum(value, -MOST), np.where(top < 0, -MOST, MOST))


def _active(left: pa.Table, right: pa.Table, k: int):
    """For slices of queries: (slice, scores, which are in the query's interval, best-k mask of them)."""
    q, c = _matrix(left), _matrix(right)
    qid, cid = left.column("row").to_numpy(), right.column("row").to_numpy()
    low, high = left.column("low").to_numpy(), left.column("high").to_numpy()
    step = max(1, 2_000_000 // max(1, len(cid)))
    for a in range(0, len(qid), step):
        part = slice(a, a + step)
        s = _scores(q[part], c)
        mine = (cid[None] != qid[part, None]) & (s >= low[part, None]) & (s <= high[part, None])
        least = np.int64(-(2**63))
        ranked = np.where(mine, s, least)
        if len(cid) > k:
            kth = np.partition(ranked, len(cid) - k, axis=1)[:, len(cid) - k]
            mine &= ranked >= kth[:, None]
        yield part, s, mine


def _cells(queries: DataFrame, candidates: DataFrame, a: int, b: int):
    def group(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("dim", F.size("v")).withColumn("a", group(a)).withColumn("b", all_of(b))
    candidates = candidates.select(*[F.col(c).alias(c) for c in ("row", "vec_id", "v")])  # both sides may come from one table
    right = candidates.withColumn("dim", F.size("v")).withColumn("b", group(b)).withColumn("a", all_of(a))
    return left.groupBy("dim", "a", "b").cogroup(right.groupBy("dim", "a", "b"))


def _whole(columns: list[list[np.ndarray]], names: list[str]) -> pa.Table:
    return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in columns], names)


def _histogram(k: int, width: int):
    """Counts of the cell's scores by bin of ``width`` within each query's interval."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, bins, counts = [], [], []
        if not (left.num_rows and right.num_rows):  # no vectors of this length on one side
            return _whole([[], [], []], ["row", "bin", "n"])
        low = left.column("low").to_numpy()
        for part, s, mine in _active(left, right, k):
            row, col = np.nonzero(mine)
            above = s[row, col].astype(np.uint64) - low[part][row].astype(np.uint64)  # may take all 64 bits
            key, n = np.unique(row * BINS + (above // np.uint64(width)).astype(np.int64), return_counts=True)
            ids.append(left.column("row").to_numpy()[part][key // BINS])
            bins.append(key % BINS)
            counts.append(n)
        return _whole([ids, bins, counts], ["row", "bin", "n"])

    return count


def top_k(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows, ties to the smaller id."""
    vectors = common.written(int_vectors(rows), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, n_queries, largest = vectors.agg(F.count("*"), F.count_if(is_query), F.max(square)).head()
    a, b = -(-n_queries // QUERY_GROUP) or 1, -(-n // CANDIDATE_GROUP) or 1
    bound = min(MOST, int((largest or 0) * (1 + 1e-9)) + 1)  # no score is above the greatest square
    queries = vectors.filter(is_query)
    # each query's kth value is in [low, high]; need: which one of those in there
    state = queries.select("row", F.lit(-bound).cast("long").alias("low"), F.lit(bound).cast("long").alias("high"), F.lit(k).cast("long").alias("need"))
    width, rounds = 2 * bound + 1, 0
    while width > 1:
        width, before = -(-width // BINS), state
        counts = _cells(queries.join(state, "row"), vectors, a, b).applyInArrow(_histogram(k, width), "row long, bin long, n long")
        counts = counts.groupBy("row", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("row").orderBy(F.desc("bin"))
        counts = counts.withColumn("upto", F.sum("n").over(down)).join(state, "row")
        hit = counts.filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        low = F.col("low").cast(WIDE) + F.col("bin").cast(WIDE) * F.lit(width).cast(WIDE)
        high = F.least(F.col("high").cast(WIDE), low + F.lit(width - 1).cast(WIDE))
        found = hit.select("row", low.cast("long").alias("new_low"), high.cast("long").alias("new_high"), (F.col("need") - F.col("upto") + F.col("n")).alias("new_need"))
        # queries with fewer than k others keep all of them: their interval stays at its low end
        state = state.join(found, "row", "left").select("row", F.coalesce("new_low", "low").alias("low"), F.when(F.col("new_low").isNull(), F.col("low")).otherwise(F.col("new_high")).alias("high"), F.coalesce("new_need", "need").alias("need"))
        state = common.written(state, "kth")
        if rounds:
            common.drop(before)
        rounds += 1

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        names = ["row", "query_id", "vec_id", "score"]
        if not (left.num_rows and right.num_rows):
            return _whole(out, names)
        kth, own = left.column("kth").to_numpy(), left.column("row").to_numpy()
        cid, qid = right.column("vec_id").to_numpy(), left.column("vec_id").to_numpy()
        order = np.argsort(cid)
        right = right.take(pa.array(order))
        cid = cid[order]
        for part, s, mine in _active(left, right, len(cid)):
            ties = mine & (s == kth[part, None])
            ties &= np.cumsum(ties, axis=1) <= k
            row, col = np.nonzero((mine & (s > kth[part, None])) | ties)
            for column, values in zip(out, (own[part][row], qid[part][row], cid[col], s[row, col]), strict=True):
                column.append(values)
        return _whole(out, names)

    last = state.select("row", F.col("low").alias("kth"), "low", F.lit(bound).cast("long").alias("high"))
    best = _cells(queries.join(last, "row"), vectors, a, b).applyInArrow(keep, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
