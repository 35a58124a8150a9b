"""Exact top-k inner products: vectors by descending length, rotated partial sums, residual bounds.

Vectors are packed in blocks by descending length, queries in blocks of their own, and some blocks in a row are a group.
The longest vectors give each query a first threshold. Lengths and thresholds alone tell how many groups of vectors a block
of queries can reach; only then do vectors move, each block once to each group of queries that can reach it. A cell of a
group of queries and one of vectors is one task's work: blocks from the longest on, each raising the thresholds for the
next, and within a block Cauchy-Schwarz on the rotated tail leaves out vectors before their exact products are taken.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import MERGERS, ship, written

#: Results for each query; rows of a vector block, of a query block, and of the block that gives first thresholds.
K, BLOCK, QUERY_BLOCK, SEEDS = 10, 4096, 4096, 1024
#: Most blocks of a group (a vector moves once for so many query blocks) while there are CELLS cells at least; numbers in a block.
GROUP, CELLS, NUMBERS = 16, 4096, 1 << 19
#: Head of the rotated vectors: the leading directions that hold this share of the squared length.
HEAD_SHARE = 0.6
#: Products up to here are exact in float64.
_EXACT = float(1 << 53)


def integer_vector(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as long; null for a vector with a null or non-finite component."""
    real = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & sound, F.transform(real, lambda x: F.floor(x * scale).cast("long")))


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; Python integers where float64 could round, held to the range of long."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    if not len(a) or not len(b) or np.abs(x).sum(1).max() * np.abs(y).max(initial=0) < _EXACT:
        return (x @ y.T).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.array([[min(max(int(v), low), high) for v in row] for row in exact], np.int64).reshape(len(a), len(b))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id, highest first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= least)
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))][:k]


def rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Right singular vectors of all rows, leading first, and the size of the head.

    They are those of one sum of width x width products: each task has one matrix, a tree of tasks adds them up, and one
    comes back.
    """
    schema = "g binary"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch["_v"].tolist(), width).astype(np.float64)
            gram += x.T @ x
        yield pd.DataFrame({"g": [gram.tobytes()]})

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = np.zeros(width * width)
        for batch in batches:
            for part in batch["g"]:
                gram += np.frombuffer(part)
        yield pd.DataFrame({"g": [gram.tobytes()]})

    parts = vectors.select("_v").mapInPandas(partial, schema).repartition(MERGERS).mapInPandas(added, schema)
    whole = parts.coalesce(1).mapInPandas(added, schema).first()["g"]
    values, basis = np.linalg.eigh(np.frombuffer(whole).reshape(width, width))
    held = np.cumsum(values[::-1].clip(0))
    head = int(np.searchsorted(held, HEAD_SHARE * held[-1]) + 1) if width and held[-1] > 0 else width
    return basis[:, ::-1], min(head, width)


def _pack(rows: DataFrame, size: int, width: int, kind: str, group_size: int) -> DataFrame:
    """Blocks of up to ``size`` rows, in the order of the partitions: ids, integers, the largest length, and the group.

    A group is some partitions in a row, so groups are ordered by length as the rows are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        group = TaskContext.get().partitionId() // group_size

        def block() -> pd.DataFrame:
            part = pd.concat(held)
            x = _matrix(part["_v"].tolist(), width)
            ids = part["_id"].to_numpy(np.int64)
            length = np.sqrt((x.astype(np.float64) ** 2).sum(1)).max()
            return pd.DataFrame({f"{kind}_ids": [ids.tobytes()], f"{kind}_vectors": [x.tobytes()], f"{kind}_length": [length], f"{kind}_group": [group]})

        for batch in batches:
            while len(batch):
                room = size - sum(map(len, held))
                held.append(batch.iloc[:room])
                batch = batch.iloc[room:]
                if sum(map(len, held)) == size:
                    yield block()
                    held.clear()
        if held:
            yield block()

    return rows.mapInPandas(run, f"{kind}_ids binary, {kind}_vectors binary, {kind}_length double, {kind}_group int")


def _ordered(rows: DataFrame, n: int, size: int) -> DataFrame:
    """Rows by descending length; the id parts equal vectors, which may be a large share of all."""
    order = [F.col("_length").desc(), F.col("_id")]
    return rows.repartitionByRange(max(1, -(-n // size)), *order).sortWithinPartitions(*order)


def search(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer products of each query row with all rows but its own id.

    Vectors that are null, or hold null or non-finite components, and rows without an id take no part. Vectors of unequal
    dimension are as if filled up with zeros. Copies are candidates like all others; ties go to the smaller id. A query
    with fewer rivals gets fewer rows; an empty table gives none. Query rows of one id are one query, of the smallest vector
    by its components in order; as candidates all rows stay. Other columns are not carried.
    """
    ship(vectors.sparkSession)
    whole = integer_vector(F.col(vector), scale)
    rows = vectors.select(F.col(key).cast("long").alias("_id"), whole.alias("_v"), is_query.alias("_query")).where("_id IS NOT NULL AND _v IS NOT NULL")
    length = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = written(rows.withColumn("_length", length), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("_query").alias("q"), F.max(F.size("_v")).alias("w")).first()
    n, n_queries, width = size["n"], size["q"], size["w"] or 0
    schema = "query_id long, vec_id long, score long"
    if not n_queries:
        return vectors.sparkSession.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    turned, head = rotation(rows, width)
    seeds = rows.orderBy(F.col("_length").desc(), "_id").limit(SEEDS).collect()
    seed_ids = np.array([r["_id"] for r in seeds], np.int64)
    seed_vectors = _matrix([r["_v"] for r in seeds], width)

    def thresholds(lengths: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        """The k-th best score of each query among the seeds, the lowest number if there are fewer; and how far its block reaches."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for ids, x in zip(batch["q_ids"], batch["q_vectors"], strict=True):
                    own = np.frombuffer(ids, np.int64)
                    scores = exact_products(np.frombuffer(x, np.int64).reshape(len(own), width), seed_vectors)
                    low = np.full(len(own), np.iinfo(np.int64).min)
                    for i, q in enumerate(own):
                        mine = scores[i][seed_ids != q]
                        if len(mine) >= k:
                            low[i] = np.partition(mine, len(mine) - k)[len(mine) - k]
                    out.append(low)
                far = [reachable(lengths, q, float(low.min())) for q, low in zip(batch["q_length"], out, strict=True)]
                yield batch.assign(q_low=[low.tobytes() for low in out], q_cells=far)

        return run

    block, query_block = (max(16, min(most, NUMBERS // max(1, width))) for most in (BLOCK, QUERY_BLOCK))
    group = max(1, min(GROUP, math.isqrt(-(-n // block) * -(-n_queries // query_block) // CELLS)))
    blocks = written(_pack(_ordered(rows, n, block), block, width, "c", group), "vector-blocks")
    groups = blocks.groupBy("c_group").agg(F.max("c_length").alias("length")).orderBy("c_group").collect()
    lengths = np.zeros(groups[-1]["c_group"] + 1)
    for r in groups:
        lengths[r["c_group"]] = r["length"]
    asked = rows.where("_query").groupBy("_id").agg(F.min("_v").alias("_v"), F.min_by("_length", "_v").alias("_length"))
    queries = _pack(_ordered(asked, n_queries, query_block), query_block, width, "q", group)
    schema_of_queries = "q_ids binary, q_vectors binary, q_length double, q_group int, q_low binary, q_cells int"
    queries = written(queries.mapInPandas(thresholds(lengths), schema_of_queries), "query-blocks", last=[rows])
    cells = {r["q_group"]: r["cells"] for r in queries.groupBy("q_group").agg(F.max("q_cells").alias("cells")).collect()}
    dealt, met = dealt_queries(queries), dealt_vectors(blocks, cells)

    def products(key: tuple, mine: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        others = others.sort_values("c_length", ascending=False)
        return pd.concat([_cell_best(row, others, turned, head, width, k) for row in mine.itertuples(index=False)] or [pd.DataFrame(columns=["query_id", "vec_id", "score"], dtype="int64")])

    found = dealt.groupBy("_q", "_c").cogroup(met.groupBy("_q", "_c")).applyInPandas(products, schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def reachable(lengths: np.ndarray, q_length: float, least: float) -> int:
    """How many groups of vectors, the longest first, hold one whose product with such a query can reach ``least``."""
    # Groups are in the order of their lengths but for empty ones.
    sound = np.flatnonzero(q_length * lengths * (1 + 1e-9) + 1 >= least)
    return int(sound[-1]) + 1 if len(sound) else 0


def dealt_queries(queries: DataFrame) -> DataFrame:
    """A row for each query block and group of vectors that it can reach."""
    return queries.where("q_cells > 0").withColumns({"_q": F.col("q_group"), "_c": F.explode(F.sequence(F.lit(0), F.col("q_cells") - 1))})


def dealt_vectors(blocks: DataFrame, cells: dict[int, int]) -> DataFrame:
    """A row for each vector block and group of queries that can reach its group; others never move."""
    reach = sorted(cells.items())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(_to=[[q for q, n in reach if n > c] for c in batch["c_group"]])

    shaped = blocks.mapInPandas(run, "c_ids binary, c_vectors binary, c_length double, c_group int, _to array<int>")
    return shaped.select("c_ids", "c_vectors", "c_length", F.col("c_group").alias("_c"), F.explode("_to").alias("_q"))


def _cell_best(row, others: pd.DataFrame, turned: np.ndarray, head: int, width: int, k: int) -> pd.DataFrame:
    """The k best of some vector blocks, the longest first, for each query of a block: each block raises the thresholds of the next."""
    q_ids, low = (np.frombuffer(b, np.int64) for b in (row.q_ids, row.q_low))
    low = low.copy()
    best_ids, best_scores = [np.zeros(0, np.int64) for _ in q_ids], [np.zeros(0, np.int64) for _ in q_ids]
    for other in others.itertuples(index=False):
        if row.q_length * other.c_length * (1 + 1e-9) + 1 < low.min():
            break
        found = _block_best(row, other, low, turned, head, width, k)
        for i, (ids, scores) in found.items():
            ids, scores = np.append(best_ids[i], ids), np.append(best_scores[i], scores)
            top = best(scores, ids, k)
            best_ids[i], best_scores[i] = ids[top], scores[top]
            if len(top) == k:
                low[i] = max(low[i], best_scores[i][-1])
    sizes = [len(x) for x in best_ids]
    return pd.DataFrame({"query_id": np.repeat(q_ids, sizes), "vec_id": np.concatenate(best_ids), "score": np.concatenate(best_scores)}).astype("int64")


def _block_best(row, other, low: np.ndarray, turned: np.ndarray, head: int, width: int, k: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of the k best of a vector block for each query by its place, without those that cannot reach its threshold."""
    q_ids, c_ids = (np.frombuffer(b, np.int64) for b in (row.q_ids, other.c_ids))
    q, c = (np.frombuffer(b, np.int64).reshape(-1, width) for b in (row.q_vectors, other.c_vectors))
    qr, cr = q.astype(np.float64) @ turned, c.astype(np.float64) @ turned
    q_length, c_length = np.linalg.norm(qr, axis=1), np.linalg.norm(cr, axis=1)
    q_tail, c_tail = np.linalg.norm(qr[:, head:], axis=1), np.linalg.norm(cr[:, head:], axis=1)
    least = low.astype(np.float64)
    out = {}
    for i, query in enumerate(q_ids):
        slack = 1 + 1e-9 * q_length[i] * c_length[0]  # rounding of the rotated sums
        near = np.searchsorted(-c_length, -(least[i] - slack) / max(q_length[i], 1e-300), side="right")
        bound = cr[:near, :head] @ qr[i, :head] + q_tail[i] * c_tail[:near]
        open_ = np.flatnonzero((bound + slack >= least[i]) & (c_ids[:near] != query))
        if not len(open_):
            continue
        scores = exact_products(q[i : i + 1], c[open_])[0]
        top = best(scores, c_ids[open_], k)
        out[i] = (c_ids[open_][top], scores[top])
    return out
