"""Exact top-k search by inner product through a pivot-distance index."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Vectors the pivots and annuli are chosen from; they decide costs, not results.
SAMPLE = 8_192
PIVOTS = 24
RINGS = 4
# Vectors of a block, the unit that a task holds, and about as many queries as pass one copy of it. Queries
# aren't held, so that their number bounds the time of a task only.
BLOCK_VECTORS = 32_768
BLOCK_QUERIES = 262_144
# Vectors a query scores in its nearest annuli before it prunes.
FIRST_VECTORS = 512
_SLACK = 1e-6
_TILE = 128
_SENT_BYTES = 16 << 20


def quantized(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec``: each component floor(256 * x) of the vectors without null or non-finite ones.
    Rows without id or vector are left out."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select("vec_id", whole.alias("embedding"))
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False)))
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x * 256)).alias("vec")))


class Index:
    """Pivots and annuli. Vectors v are mapped to (v, sqrt(m^2 - |v|^2)) with m the largest norm, and
    queries q to (q, 0): then the larger the inner product, the smaller the Euclidean distance. A
    vector's key is its nearest pivot and the distance to it; ``edges`` cut the distances of a pivot
    into annuli."""

    def __init__(self, sample: np.ndarray, largest: float, pivots: int, rings: int, seed: int = 1) -> None:
        self.width = sample.shape[1]
        self.square = largest
        points = self.lifted(sample)
        rng = np.random.default_rng(seed)
        centres = points[np.sort(rng.permutation(len(points))[:pivots])]
        for _ in range(8):
            nearest = self._distances(points, centres).argmin(axis=1)
            centres = np.stack([points[nearest == p].mean(axis=0) if (nearest == p).any() else c
                                for p, c in enumerate(centres)])
        self.centres = centres
        distances = self._distances(points, centres)
        nearest = distances.argmin(axis=1)
        shares = np.arange(1, rings) / rings
        self.edges = np.stack([
            np.quantile(distances[nearest == p, p] if (nearest == p).any() else np.zeros(1), shares)
            for p in range(len(centres))])
        self.rings = rings

    @staticmethod
    def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        squares = (points ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1)[None, :] - 2 * points @ centres.T
        return np.sqrt(np.maximum(squares, 0))

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.square - (vectors ** 2).sum(axis=1), 0))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell (pivot and annulus) and distance to the pivot."""
        distances = self._distances(self.lifted(vectors), self.centres)
        pivot = distances.argmin(axis=1)
        distance = distances[np.arange(len(vectors)), pivot]
        ring = (distance[:, None] > self.edges[pivot]).sum(axis=1)
        return pivot * self.rings + ring, distance

    def query_distances(self, queries: np.ndarray) -> np.ndarray:
        return self._distances(np.concatenate([queries, np.zeros((len(queries), 1))], axis=1), self.centres)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, vec in enumerate(column):
        out[i, :len(vec)] = vec
    return out


def _packing(largest: int, width: int) -> tuple[str, type]:
    """Storage of components, and the type in which inner products of them are exact."""
    kind = next(k for k, top in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 64)) if largest < top)
    return kind, float if largest * largest * width < 1 << 53 else np.int64


class _Cells:
    """The annuli that hold vectors: their numbers, sizes and blocks, and what lies between them and
    a query."""

    def __init__(self, index: Index, frame: pd.DataFrame) -> None:
        self.index = index
        self.cell, self.size = frame["cell"].to_numpy(), frame["n"].to_numpy()
        self.near, self.far = frame["near"].to_numpy(), frame["far"].to_numpy()
        self.blocks = -(-self.size // BLOCK_VECTORS)

    def least(self, queries: np.ndarray) -> np.ndarray:
        """Least distance that a vector of each annulus can have from each query, by the triangle
        inequality."""
        own = self.index.query_distances(queries)[:, self.cell // self.index.rings]
        slack = _SLACK * (1 + np.sqrt(self.index.square))
        return np.maximum(np.maximum(own - self.far, self.near - own) - slack, 0)

    def first(self, least: np.ndarray) -> np.ndarray:
        """The nearest annuli of each query, as many as hold ``FIRST_VECTORS``."""
        order = np.argsort(least, axis=1, kind="stable")
        ahead = self.size[order].cumsum(axis=1) - self.size[order]
        out = np.zeros(least.shape, dtype=bool)
        np.put_along_axis(out, order, ahead < FIRST_VECTORS, axis=1)
        return out

    def within(self, queries: np.ndarray, least: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Annuli that may hold a score of at least ``bounds`` (nan: no bound)."""
        reach = (queries ** 2).sum(axis=1) + self.index.square - 2 * bounds
        radius = np.where(np.isnan(bounds), np.inf, np.sqrt(np.maximum(reach, 0)))
        return least <= radius[:, None]


class _Block:
    """The vectors of one block."""

    def __init__(self, kind: str, width: int, exact: type) -> None:
        self.kind, self.width, self.exact = kind, width, exact
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.ids, self.matrix = np.zeros(0, dtype=np.int64), np.zeros((0, width), dtype=exact)

    def _unpacked(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.kind).reshape(-1, self.width).astype(self.exact)

    def add(self, ids: pa.Array, packed: pa.Array) -> None:
        self.parts.append((ids.to_numpy(), self._unpacked(b"".join(packed.to_pylist()))))

    def best(self, ids: bytes, forms: bytes, packed: bytes, k: int) -> Iterator[pa.RecordBatch]:
        """The ``k`` vectors of the highest scores for each of these queries, its own id left out."""
        if self.parts:
            self.ids = np.concatenate([self.ids, *(part for part, _ in self.parts)])
            order = np.argsort(self.ids, kind="stable")
            self.ids = self.ids[order]
            self.matrix = np.concatenate([self.matrix, *(part for _, part in self.parts)])[order]
            self.parts = []
        own, forms, queries = np.frombuffer(ids, "<i8"), np.frombuffer(forms, "<i4"), self._unpacked(packed)
        few = min(k, len(self.ids))
        if not few:
            return
        for i in range(0, len(own), _TILE):
            one = own[i:i + _TILE]
            scores = queries[i:i + _TILE] @ self.matrix.T
            mine = one[:, None] == self.ids[None, :]
            # Ties: the k-th score bounds the candidates, whose ids decide.
            masked = np.where(mine, -np.inf, scores)
            bound = -np.partition(-masked, few - 1, axis=1)[:, few - 1]
            q, v = np.nonzero((masked >= bound[:, None]) & ~mine)
            value = scores[q, v]
            order = np.lexsort((v, -value, q))
            q, v, value = q[order], v[order], value[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q) < k
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[q[keep]]), pa.array(forms[i:i + _TILE][q[keep]]), pa.array(self.ids[v[keep]]),
                 pa.array(value[keep].astype(np.int64))], ["query_id", "form", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` vectors of the highest inner
    product, ties to the smaller vec_id; all, if there are fewer.

    ``vectors`` has ``vec_id`` and ``vec`` (integers, ``quantized``); ``is_query`` marks the queries.
    Every row but those of the query's own id is a candidate. Rows that repeat an id and vector are
    candidates each, but one query; an id with several vectors queries with each of them, and the
    ranks run over all its answers. Shorter vectors count as padded with zeros. Empty tables, no
    queries or a single vector give an empty result. Other columns are ignored.

    Vectors are dealt to annuli around pivots. A query first scores the vectors of its nearest annuli,
    which bounds the distance of its k-th answer; it then visits, in a second step, only annuli that
    the triangle inequality doesn't rule out. Annuli are cut into blocks of bounded size by count. A
    task holds one block and lets its queries pass in order of blocks; there is one copy of a block for
    each ``BLOCK_QUERIES`` queries. Only the sizes of the annuli (``PIVOTS * RINGS`` rows) come to the
    driver.
    """
    spark = vectors.sparkSession
    vectors = stored(vectors.select("vec_id", "vec"), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = vectors.agg(
        F.count("*").alias("n"), F.max(square).alias("square"), F.max(F.size("vec")).alias("width"),
        F.max(F.array_max(F.transform("vec", F.abs))).alias("largest")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, facts["width"])
    kind, exact = _packing(facts["largest"] or 0, width)
    drawn = vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(facts["n"])) < SAMPLE).select("vec").toPandas()
    sample = _matrix(drawn["vec"], width) if len(drawn) else np.zeros((1, width))
    index = Index(sample, float(facts["square"] or 0), PIVOTS, RINGS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                matrix = _matrix(batch.column(1).to_pandas(), width)
                cell, distance = index.keys(matrix)
                packed = pa.array([row.tobytes() for row in matrix.astype(kind)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), packed, pa.array(cell.astype(np.int64)), pa.array(distance)],
                    ["vec_id", "packed", "cell", "distance"])

    placed = stored(vectors.mapInArrow(place, "vec_id long, packed binary, cell long, distance double"), "annuli")
    cells = _Cells(index, placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far"))
        .toPandas().sort_values("cell"))
    sizes = spark.createDataFrame([*zip(cells.cell.tolist(), cells.blocks.tolist())], "cell long, blocks long")
    asked = stored(
        vectors.filter(is_query).groupBy("vec_id").agg(F.collect_set("vec").alias("vecs"))
        .select(F.col("vec_id").alias("query_id"), F.posexplode("vecs").alias("form", "vec")), "queries")
    groups = max(1, -(-asked.count() // BLOCK_QUERIES))
    held = (placed.join(F.broadcast(sizes), "cell")
            .withColumn("block", F.pmod(F.xxhash64("vec_id", "distance"), F.col("blocks")))
            .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
            .select("cell", "block", "group", F.lit(False).alias("asks"), "vec_id",
                    F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("forms"), "packed"))
    route = "cell long, block long, group long, ids binary, forms binary, packed binary"
    found = "query_id long, form int, vec_id long, score long"

    def routed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.binary()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                          [part.split()[0] for part in route.split(", ")])

    def visits(second: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Queries, packed together, for each block they visit: one block of each of the nearest
        annuli, or all other blocks within the bound."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                frame = batch.to_pandas()
                if not len(frame):
                    continue
                queries = _matrix(frame["vec"], width)
                ids, forms = frame["query_id"].to_numpy(dtype="<i8"), frame["form"].to_numpy(dtype="<i4")
                packed = queries.astype(kind)
                least = cells.least(queries)
                first = cells.first(least)
                wanted = first
                if second:
                    wanted = cells.within(queries, least, frame["bound"].to_numpy(dtype=float, na_value=np.nan))
                rows, gathered = [], 0
                for c in np.flatnonzero(wanted.any(axis=0)):
                    early = np.where(first[:, c], ids % cells.blocks[c], -1)
                    for block in range(cells.blocks[c]):
                        goes = wanted[:, c] & ((early != block) if second else (early == block))
                        for group in np.unique(ids[goes] % groups):
                            some = goes & (ids % groups == group)
                            rows.append((int(cells.cell[c]), block, int(group), ids[some].tobytes(),
                                         forms[some].tobytes(), packed[some].tobytes()))
                            gathered += len(rows[-1][-1])
                        if gathered > _SENT_BYTES:
                            yield routed(rows)
                            rows, gathered = [], 0
                if rows:
                    yield routed(rows)
        return run

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best ``k`` of a block for each query that visits it. Rows come in order of blocks, the
        vectors of a block ahead of its queries."""
        key, block = None, _Block(kind, width, exact)
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            keys = np.stack([columns[c].to_numpy() for c in ("cell", "block", "group")], axis=1)
            asks = columns["asks"].to_numpy(zero_copy_only=False)
            changes = (keys[1:] != keys[:-1]).any(axis=1) | (asks[1:] != asks[:-1])
            edges = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                if key != tuple(keys[begin]):
                    key, block = tuple(keys[begin]), _Block(kind, width, exact)
                run = {name: column.slice(begin, end - begin) for name, column in columns.items()}
                if not asks[begin]:
                    block.add(run["vec_id"], run["packed"])
                    continue
                for ids, forms, packed in zip(*(run[c].to_pylist() for c in ("ids", "forms", "packed"))):
                    yield from block.best(ids, forms, packed, k)

    def meet(visited: DataFrame) -> DataFrame:
        keys = ["cell", "block", "group"]
        asking = visited.select(*keys, F.lit(True).alias("asks"), F.lit(None).cast("long").alias("vec_id"),
                                "ids", "forms", "packed")
        return (held.union(asking).repartition(*keys).sortWithinPartitions(*keys, "asks")
                .mapInArrow(score, found))

    first = stored(meet(asked.mapInArrow(visits(False), route)), "nearest")
    best = Window.partitionBy("query_id", "form").orderBy(F.col("score").desc(), "vec_id")
    bounds = (first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
              .select(F.col("query_id").alias("_id"), F.col("form").alias("_form"), F.col("score").alias("bound")))
    bounded = asked.join(bounds, (F.col("query_id") == F.col("_id")) & (F.col("form") == F.col("_form")), "left")
    rest = meet(bounded.select("query_id", "form", "vec", "bound").mapInArrow(visits(True), route))
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id", "form")
    return (first.union(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(ranked).cast("int"))
            .select("query_id", "rank", "vec_id", "score"))
