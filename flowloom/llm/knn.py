"""Exact top-k by inner product as a Voronoi join.

Vectors and queries are grouped by their nearest pivot and packed in blocks of bounded size, so that a
crowded pivot is shared by many blocks.  A bounded sample of the vectors gives each query a score that
its k-th best cannot fall below; the pivot and radius of a group bound what its members can score.  A
query block is sent only to groups that a query of it may still need, solved there with matrix
products, and each task passes on k results per query at most.

Defined cases: vectors that are null or hold null or non-finite components, and rows with null id, take
no part; shorter vectors count as padded with zeros; a query never meets rows of its own id; rows that
repeat an id are candidates each, and queries each, so ranks of a query id may repeat a row; ties go to the smaller id; fewer candidates than k give fewer rows; scores beyond a long stay at its limits; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.sized import keep

#: Pivots, taken from the sample.
PIVOTS = 32
#: Vectors sampled for pivots and score floors; collected and sent to all tasks.
SAMPLE = 2048
#: Rows of a block, on average at most.
BLOCK = 1024
#: Results a task gathers before it drops what cannot be among the best.
HELD = 1 << 20
LONG = np.iinfo(np.int64)


def usable(embeddings: DataFrame, scale: float) -> DataFrame:
    """``vec_id, v``: integer components as doubles, of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    limit = float("inf")
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < limit))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fine).select("vec_id", F.transform("x", lambda e: e * scale).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Floored components, one row per vector, padded with zeros."""
    out = np.zeros((len(column), width))
    lengths = np.asarray(column.value_lengths())
    flat = np.floor(np.asarray(column.flatten(), dtype=np.float64))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def packed(values: np.ndarray) -> tuple[str, bytes]:
    """The smallest type that holds the values exactly."""
    for kind in ("i1", "i2", "i4"):
        info = np.iinfo(kind)
        if not values.size or (values.min() >= info.min and values.max() <= info.max):
            return kind, values.astype(kind).tobytes()
    return "f8", values.astype("f8").tobytes()


def unpacked(kind: str, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(-1, width).astype(np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles while they hold every sum, else Python's integers."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in a], dtype=object) @ np.array([[int(x) for x in r] for r in b], dtype=object).T
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


def best(query: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of each query, ties to the smaller id."""
    order = np.lexsort((vec, -score.astype(np.float64) if score.dtype != np.int64 else np.bitwise_not(score), query))
    query, score, vec = query[order], score[order], vec[order]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    rank = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0))
    stay = rank < k
    return query[stay], score[stay], vec[stay]


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest inner products; queries are the ids divisible by ``every``."""
    spark = embeddings.sparkSession
    rows = keep(usable(embeddings, scale).select(F.monotonically_increasing_id().alias("row"), "*"))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    drawn = rows.orderBy(F.xxhash64("row"), "row").limit(sample).toPandas()
    s_ids = drawn["vec_id"].to_numpy(dtype=np.int64)
    s_rows = matrix(pa.array(drawn["v"].tolist(), pa.list_(pa.float64())), width)
    sample_of = spark.sparkContext.broadcast((s_ids, s_rows, s_rows[:pivots]))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sample_of.value[2]
        for batch in batches:
            v = matrix(batch.column("v"), width)
            distance = (v**2).sum(1)[:, None] - 2 * v @ centres.T + (centres**2).sum(1)[None, :]
            group = distance.argmin(1) if len(v) else np.zeros(0, dtype=np.int64)
            radius = np.sqrt(((v - centres[group]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), pa.array(group, pa.int32()), pa.array(radius), pa.array([r.tobytes() for r in v], pa.binary())], names=["row", "vec_id", "g", "radius", "v"])

    assigned = keep(rows.mapInArrow(assign, "row long, vec_id long, g int, radius double, v binary"))
    asked = (F.col("vec_id") % every == 0).alias("asked")
    summary = keep(assigned.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius"), F.count_if(F.col("vec_id") % every == 0).alias("n_asked")))
    radii = {r["g"]: r["radius"] for r in summary.collect()}  # one row per pivot
    salt = F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / BLOCK))
    keyed = assigned.join(F.broadcast(summary.select("g", "n", "n_asked")), "g").withColumn("asked", asked)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        kind, data = packed(np.frombuffer(b"".join(frame["v"]), dtype=np.float64))
        return pd.DataFrame({"g": frame["g"].iloc[:1], "ids": [frame["vec_id"].to_numpy(dtype=np.int64).tobytes()], "kind": [kind], "data": [data]})

    layout = "g int, ids binary, kind string, data binary"
    blocks = keep(keyed.withColumn("b", salt).select("g", "b", "vec_id", "v").groupBy("g", "b").applyInPandas(pack, layout))
    q_salt = F.pmod(F.xxhash64("row"), F.ceil(F.col("n_asked") / BLOCK))
    q_blocks = keyed.filter("asked").withColumn("b", q_salt).select("g", "b", "vec_id", "v").groupBy("g", "b").applyInPandas(pack, layout)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known, centres = sample_of.value
        groups = np.array(sorted(radii), dtype=np.int64)
        reach = np.array([radii[g] for g in groups])
        for batch in batches:
            floors, needs = [], []
            for row in batch.to_pylist():
                q, q_ids = unpacked(row["kind"], row["data"], width), np.frombuffer(row["ids"], dtype=np.int64)
                floor = np.full(len(q), LONG.min)
                score = products(q, known)
                own = q_ids[:, None] == ids[None, :]
                for i in range(len(q)):
                    others = score[i][~own[i]]
                    if len(others) >= k:
                        floor[i] = np.partition(others, len(others) - k)[len(others) - k]
                bound = q @ centres[groups].T + np.sqrt((q**2).sum(1))[:, None] * reach[None, :]
                wanted = (bound * (1 + 1e-9 * np.sign(bound)) + 1e-3 >= floor[:, None]).any(0)
                floors.append(floor.tobytes())
                needs.append(groups[wanted].astype(np.int32).tolist())
            columns = [*(batch.column(c) for c in ("ids", "kind", "data")), pa.array(floors, pa.binary()), pa.array(needs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "kind", "data", "floors", "needs"])

    planned = keep(q_blocks.mapInArrow(plan, "ids binary, kind string, data binary, floors binary, needs array<int>"))
    sent = planned.select(F.col("ids").alias("q_ids"), F.col("kind").alias("q_kind"), F.col("data").alias("q_data"), "floors", F.explode("needs").alias("g"))
    pairs = sent.join(blocks, "g")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, dtype=np.int64)
        parts, held = [(empty, empty, empty)], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                q_ids, ids = np.frombuffer(row["q_ids"], dtype=np.int64), np.frombuffer(row["ids"], dtype=np.int64)
                score = products(unpacked(row["q_kind"], row["q_data"], width), unpacked(row["kind"], row["data"], width))
                fits = (score >= np.frombuffer(row["floors"], dtype=np.int64)[:, None]) & (q_ids[:, None] != ids[None, :])
                at, to = np.nonzero(fits)
                parts.append(best(q_ids[at], score[at, to], ids[to], k))
                held += len(parts[-1][0])
                if held > HELD:
                    parts = [best(*(np.concatenate(x) for x in zip(*parts, strict=True)), k)]
                    held = len(parts[0][0])
                    if held > HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["query_id", "score", "vec_id"])
                        parts, held = [(empty, empty, empty)], 0
        found = best(*(np.concatenate(x) for x in zip(*parts, strict=True)), k)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "score", "vec_id"])

    found = pairs.mapInArrow(solve, "query_id long, score long, vec_id long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
