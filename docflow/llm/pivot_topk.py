"""Exact top-k by inner product over a pivot-distance index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import stored

SCALE = 1024
SAMPLE = 4096  # rows that place the pivots, whatever the size of the table
PIVOTS = 64
ANNULI = 16
CHUNK_ROWS = 1024
QUERY_BLOCK = 256
FIRST_CELLS = 4
TOP = 10

PLACED = "vec_id bigint, pivot int, r double, v binary"
CHUNK = "base bigint, cell int, n int, r_min double, r_max double, ids binary, v binary"
STATE = "uid bigint, query_id bigint, v binary, scores array<bigint>, ids array<bigint>, visited int, open boolean"
HITS = "uid bigint, scores array<bigint>, ids array<bigint>"


def whole_components(vector: Column) -> Column:
    """floor(1024 * x) of every component, NULL for vectors that are NULL or hold NULL or non-finite components."""
    x = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")))


class Space:
    """Inner products as distances: with one more coordinate, sqrt(bound - |x|^2) for rows and 0 for queries,
    |q - x|^2 = |q|^2 + bound - 2 q.x, so that the nearest rows are those of the highest score."""

    def __init__(self, dim: int, bound: float, largest: int):
        self.dim, self.bound = dim, float(bound)
        self.exact_in_floats = dim * float(largest) ** 2 < 2**53
        self.dtype = "<i4" if largest < 2**31 else "<i8"

    def matrix(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), self.dtype).reshape(-1, self.dim)

    def rows(self, m: np.ndarray) -> np.ndarray:
        m = m.astype(float)
        rest = np.sqrt(np.maximum(self.bound - (m * m).sum(1), 0))
        return np.hstack([m, rest[:, None]])

    def queries(self, m: np.ndarray) -> np.ndarray:
        return np.hstack([m.astype(float), np.zeros((len(m), 1))])

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.exact_in_floats:
            return (a.astype(float) @ b.astype(float).T).astype(np.int64)
        return a.astype(np.int64) @ b.astype(np.int64).T


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres of a few rounds of k-means over the sample. Any pivots give right results, good ones give few visits."""
    centres = x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = distances(x, centres).argmin(1)
        for k in range(len(centres)):
            if (near == k).any():
                centres[k] = x[near == k].mean(0)
    return centres


def place(vectors: DataFrame, space: Space, pivots: np.ndarray) -> DataFrame:
    """Nearest pivot of every row and the distance to it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.zeros((batch.num_rows, space.dim), space.dtype)
            for line, v in zip(m, batch.column("v").to_pylist()):
                line[: len(v)] = v
            d = distances(space.rows(m), pivots)
            near = d.argmin(1) if len(d) else np.zeros(0, int)
            r = d[np.arange(len(d)), near]
            made = [pa.array(near, pa.int32()), pa.array(r, pa.float64()), pa.array([x.tobytes() for x in m], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *made], names=["vec_id", "pivot", "r", "v"])

    return vectors.mapInArrow(rows, PLACED)


def chunk(placed: DataFrame, cuts: dict[int, np.ndarray], parts: int) -> DataFrame:
    """Rows in the order of pivot and distance, in chunks of one cell each. A cell of any size is many chunks."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, held = TaskContext.get().partitionId() << 40, []

        def flush() -> pa.RecordBatch:
            nonlocal base, held
            held.sort(key=lambda x: (x[1] is None, x[1]))
            r = [x[2] for x in held]
            row = {"base": base, "cell": held[0][0], "n": len(held), "r_min": min(r), "r_max": max(r), "ids": np.array([x[1] for x in held], "<i8").tobytes(), "v": b"".join(x[3] for x in held)}
            base, held = base + len(held), []
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("base", pa.int64()), ("cell", pa.int32()), ("n", pa.int32()), ("r_min", pa.float64()), ("r_max", pa.float64()), ("ids", pa.binary()), ("v", pa.binary())]))

        for batch in batches:
            for vec_id, pivot, r, v in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "pivot", "r", "v"))):
                cell = pivot * ANNULI + int(np.searchsorted(cuts[pivot], r))
                if held and (held[0][0] != cell or len(held) == CHUNK_ROWS):
                    yield flush()
                held.append((cell, vec_id, r, v))
        if held:
            yield flush()

    ordered = placed.repartitionByRange(parts, "pivot", "r", "vec_id").sortWithinPartitions("pivot", "r", "vec_id")
    return ordered.mapInArrow(chunks, CHUNK)


class Search:
    """Rounds of visits: every query visits its next cells in the order of their lower bounds."""

    def __init__(self, space: Space, pivots: np.ndarray, cells: list, top: int):
        self.space, self.pivots, self.top = space, pivots, top
        self.cell = np.array([c["cell"] for c in cells], int)
        self.r_min = np.array([c["r_min"] for c in cells], float)
        self.r_max = np.array([c["r_max"] for c in cells], float)

    def states(self, chunks: DataFrame, every: int) -> DataFrame:
        """Queries: rows whose id is divisible by ``every``."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = {n: [] for n in ("uid", "query_id", "v", "scores", "ids", "visited", "open")}
                for base, ids, v in zip(*(batch.column(c).to_pylist() for c in ("base", "ids", "v"))):
                    m = self.space.matrix([v])
                    for i, vec_id in enumerate(np.frombuffer(ids, "<i8").tolist()):
                        if vec_id % every == 0:
                            for name, value in zip(out, (base + i, vec_id, m[i].tobytes(), [], [], 0, True)):
                                out[name].append(value)
                types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

        return chunks.select("base", "ids", "v").mapInArrow(rows, STATE)

    def ahead(self, q: np.ndarray, scores: list[int], visited: int, cells: int) -> np.ndarray:
        """The next cells that can hold a row as near as the last of the best: by the triangle inequality, a row at distance
        r from a pivot is at least ``abs(d - r)`` from a query at distance d from it."""
        x = self.space.queries(q[None])
        d = distances(x, self.pivots)[0][self.cell // ANNULI]
        low = np.maximum(0, np.maximum(d - self.r_max, self.r_min - d))
        order = np.argsort(low, kind="stable")[visited : visited + cells]
        if len(scores) < self.top:
            return self.cell[order]
        reach = np.sqrt(max(0.0, float((x * x).sum()) + self.space.bound - 2.0 * scores[-1]))
        # A hair of room for rounding: a visit too many does no harm.
        return self.cell[order[low[order] <= reach * (1 + 1e-9) + 1e-3]]

    def probes(self, states: DataFrame, cells: int, blocks: int) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for uid, v, scores, visited in zip(*(batch.column(c).to_pylist() for c in ("uid", "v", "scores", "visited"))):
                    out += [(int(c), uid, v) for c in self.ahead(self.space.matrix([v])[0], scores, visited, cells)]
                columns = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.binary()))], names=["cell", "uid", "v"])

        found = states.filter("open").mapInArrow(rows, "cell int, uid bigint, v binary")
        block = F.pmod(F.xxhash64("uid"), F.lit(blocks))
        return found.groupBy("cell", block.alias("block")).agg(F.collect_list("uid").alias("uids"), F.collect_list("v").alias("vs"))

    def hits(self, probes: DataFrame, chunks: DataFrame) -> DataFrame:
        """Best rows of each query among the visited chunks, merged within each task."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, list[tuple[int, int]]] = {}

            def flush() -> pa.RecordBatch:
                uids = list(best)
                columns = [pa.array(uids, pa.int64()), *(pa.array([[sign * x[k] for x in best[u]] for u in uids], pa.list_(pa.int64())) for k, sign in ((0, -1), (1, 1)))]
                best.clear()
                return pa.RecordBatch.from_arrays(columns, names=["uid", "scores", "ids"])

            for batch in batches:
                for uids, vs, base, ids, v in zip(*(batch.column(c) for c in ("uids", "vs", "base", "ids", "v"))):
                    uids, base = np.array(uids.as_py(), np.int64), base.as_py()
                    m, names = self.space.matrix([v.as_py()]), np.frombuffer(ids.as_py(), "<i8")
                    scores = self.space.products(self.space.matrix(vs.as_py()), m)
                    own = uids - base
                    order = np.argsort(-scores, axis=1, kind="stable")[:, : self.top + 1]  # rows stand by id: ties to the smaller
                    for i, u in enumerate(uids.tolist()):
                        found = [(-int(scores[i, j]), int(names[j])) for j in order[i] if j != own[i]]
                        best[u] = sorted(best.get(u, []) + found)[: self.top]
                    if len(best) > 50_000:
                        yield flush()
            yield flush()

        return probes.join(chunks.select("cell", "base", "ids", "v").hint("merge"), "cell").select("uids", "vs", "base", "ids", "v").mapInArrow(rows, HITS)

    def merged(self, states: DataFrame, hits: DataFrame, cells: int) -> DataFrame:
        found = hits.groupBy("uid").agg(F.flatten(F.collect_list(F.arrays_zip("scores", "ids"))).alias("new"))
        pair = F.concat(F.arrays_zip("scores", "ids"), F.coalesce("new", F.array().cast("array<struct<scores:bigint,ids:bigint>>")))
        best = F.slice(F.sort_array(F.transform(pair, lambda p: F.struct((-p["scores"]).alias("s"), p["ids"].alias("i")))), 1, self.top)
        joined = states.join(found, "uid", "left").select("uid", "query_id", "v", best.alias("best"), F.col("new").isNotNull().alias("went"), "visited", "open")
        return joined.select(
            "uid", "query_id", "v", F.transform("best", lambda b: -b["s"]).alias("scores"), F.transform("best", lambda b: b["i"]).alias("ids"),
            F.when(F.col("open"), F.col("visited") + cells).otherwise(F.col("visited")).cast("int").alias("visited"), (F.col("open") & F.col("went")).alias("open"),
        )


def exact_top_k(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, top: int = TOP) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose key is divisible by ``every``, the ``top`` other rows of highest
    inner product of whole components, ties to the smaller key.

    Rows are keyed by their nearest pivot and the distance to it. A query visits the annuli in the order of their lower
    bounds, four times as many each round, and stops once no further one can hold a better row. Each round is one join
    of query blocks with the chunks of the visited cells. Only the sample, the pivots and the directory of at most
    ``PIVOTS * ANNULI`` cells reach the driver.

    Vectors that are NULL or hold NULL or non-finite components, and NULL keys, take no part. Shorter vectors count as
    filled up with zeros. Repeated rows are rows of their own: a row is only kept from finding itself.
    """
    spark = df.sparkSession
    vectors = df.select(F.col(key).cast("long").alias("vec_id"), whole_components(F.col(vector)).alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    facts = vectors.agg(F.max(F.size("v")).alias("dim"), F.max(square).alias("bound"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest"), F.count_if(F.col("vec_id") % every == 0).alias("queries"), F.count(F.lit(1)).alias("n")).first()
    if not facts["n"] or not facts["queries"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    space = Space(max(1, facts["dim"]), facts["bound"], facts["largest"] or 0)
    sample = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).collect()
    m = np.zeros((len(sample), space.dim))
    for line, row in zip(m, sample):
        line[: len(row["v"])] = row["v"]
    pivots = choose_pivots(space.rows(m), PIVOTS)
    placed = stored(place(vectors, space, pivots), "topk-placed")
    steps = [i / ANNULI for i in range(1, ANNULI)]
    cuts = {k: np.zeros(0) for k in range(len(pivots))} | {r["pivot"]: np.array(r["cuts"]) for r in placed.groupBy("pivot").agg(F.percentile_approx("r", steps, 1000).alias("cuts")).collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = stored(chunk(placed, cuts, parts), "topk-chunks")
    cells = chunks.groupBy("cell").agg(F.min("r_min").alias("r_min"), F.max("r_max").alias("r_max")).collect()
    search = Search(space, pivots, cells, top)
    states = stored(search.states(chunks, every), "topk-states")
    step = FIRST_CELLS
    while not states.filter("open").isEmpty():
        probes = search.probes(states, step, -(-facts["queries"] // QUERY_BLOCK))
        states = stored(search.merged(states, search.hits(probes, chunks), step), "topk-states")
        step *= 4
    return states.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score")
    )
