"""Exact top-k inner products over norm-sorted vectors.

Vectors are range-sorted by descending length and packed into chunks. An
orthogonal rotation from the SVD of all vectors (the eigenvectors of their Gram
matrix, summed in Spark) moves most of an inner product into the first
coordinates.

1. Every block of queries meets the longest vectors first. Their k-th best
   score is a query's threshold.
2. |q| |x| bounds a score, so a block needs only the chunks whose longest vector
   reaches threshold / |q| for some query: a leading range of the norm order.
3. A unit of work is a group of blocks and a stripe of the chunks: the partitions
   of the norm order are dealt to the stripes in turn. Its task holds the group
   and reads the stripe, longest vectors first, so a vector is copied once for
   each group, and a query once for each stripe, however many chunks there are.
4. For a block and a chunk, the partial sum over the first rotated coordinates
   plus |q rest| |x rest| (Cauchy-Schwarz) bounds each score; pairs below the
   threshold are dropped, the others get the exact integer product. The k best so
   far raise the threshold for the chunks that follow.

Thresholds never drop a score that could be among the k best, ties included,
so the result is exact whatever the data; only the work depends on it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable

CHUNK = 2048              # vectors in a chunk
BLOCK = 512               # queries in a block
SEEDS = 4096              # longest vectors that set the thresholds
GRID = 1024               # most norm boundaries known to the driver
HELD = 1 << 23            # vector components in a sorted partition, or in a group of blocks
SPREAD = 64               # fewest partitions or units, unless there are fewer chunks
WORK = 1 << 36            # pairs of rows in a unit of work
MOST_PARTS = 2048         # most partitions that units are dealt to
PACKED = "rank int, place int, n int, longest double, ids binary, values binary"
FOUND = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, and no null or non-finite component."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, padded with 0."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first. Each task sums
    its share of the Gram matrix; Spark adds the cells; width**2 numbers reach
    the driver."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("v"), width).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width), pa.int32()), pa.array(total.ravel())], ["cell", "value"])

    cells = (vectors.select("v").mapInArrow(gram, "cell int, value double")
             .groupBy("cell").agg(F.sum("value").alias("value")).toArrow())
    total = np.zeros(width * width)
    total[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    total = total.reshape(width, width)
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1].copy()


def _partitions(n: int, per_pack: int, width: int) -> int:
    """For ``n`` rows: each pack its own partition while they are few, then about
    ``HELD`` components in each. A range sort samples some 300 rows a partition
    for the driver, so a partition for every pack would be too many."""
    held = max(per_pack, HELD // width)
    return max(-(-n // held), min(-(-n // per_pack), SPREAD))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes each as they need."""
    return x.astype(np.min_scalar_type(min(int(x.min(initial=0)), -int(x.max(initial=0)) - 1)))


def _pack(rows: DataFrame, per_row: int, width: int) -> DataFrame:
    """One packed row for at most ``per_row`` rows (vec_id, v) of a partition,
    in the partition's order: ``rank`` is the partition, ``place`` counts its packs."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            for s in range(0, batch.num_rows, per_row):
                part = batch.slice(s, per_row)
                x = _matrix(part.column("v"), width)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("rank")[0].as_py()], pa.int32()), pa.array([place], pa.int32()),
                     pa.array([len(ids)], pa.int32()), pa.array([float(_lengths(x).max())]),
                     pa.array([ids.tobytes()], pa.binary()), pa.array([_narrow(x).tobytes()], pa.binary())],
                    ["rank", "place", "n", "longest", "ids", "values"])
                place += 1

    return rows.select("vec_id", "v", F.spark_partition_id().alias("rank")).mapInArrow(pack, PACKED)


def _unpack(ids: bytes, values: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    kind = f"i{len(values) // (len(own) * width)}"
    return own, np.frombuffer(values, kind).reshape(len(own), width)


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


class Turned:
    """Rows with what bounds their products: lengths, and the first rotated
    coordinates with the length of the rest."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rotation: np.ndarray) -> None:
        self.ids, self.x, self.length = ids, x, _lengths(x)
        self.longest = self.length.max(initial=0)
        self.largest = max(-float(x.min(initial=0)), float(x.max(initial=0)))
        head = max(1, x.shape[1] // 4)
        turned = x @ rotation
        self.head = np.column_stack([turned[:, :head], _lengths(turned[:, head:])]).astype(np.float32)


def _places(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each true cell (np.nonzero takes several times as long
    where these are few)."""
    return np.divmod(np.flatnonzero(chosen), chosen.shape[1])


def _k_best(row: np.ndarray, own: np.ndarray, score: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the ``k`` highest scores, ties to the smaller id."""
    order = np.lexsort((own, -score, row))
    row, own, score = row[order], own[order], score[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], own[kept], score[kept]


def best_in_chunk(q: Turned, least: np.ndarray, chunk: Turned,
                  k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vec_id, score) of each query's k best scores that reach its
    threshold ``least``, own row left out, ties to the smaller id."""
    # Rounding stays far below this slack; a bound beyond the range is no number, and kept.
    slack = 1e-5 * (1 + q.length * chunk.longest)
    with np.errstate(over="ignore", invalid="ignore"):
        reach = ~(q.head @ chunk.head.T < (least - slack).astype(np.float32)[:, None])
    largest = q.x.shape[1] * q.largest * chunk.largest
    if largest < 2 ** 53 and np.count_nonzero(reach) > 0.05 * reach.size:
        exact = np.float32 if largest < 2 ** 24 else np.float64
        scores = q.x.astype(exact) @ chunk.x.astype(exact).T
        bar = least.astype(exact)
        if len(chunk.ids) > k and np.count_nonzero(scores >= bar[:, None]) > 4 * k * len(bar):
            others = np.where(q.ids[:, None] == chunk.ids, -np.inf, scores)
            bar = np.maximum(bar, np.partition(others, -k, axis=1)[:, -k])
        row, col = _places(scores >= bar[:, None])
        score = scores[row, col].astype(np.int64)
    else:
        row, col = _places(reach)
        score = np.empty(len(row), np.int64)
        for s in range(0, len(row), 1 << 18):
            part = slice(s, s + (1 << 18))
            score[part] = np.einsum("ij,ij->i", q.x[row[part]].astype(np.int64), chunk.x[col[part]].astype(np.int64))
    kept = (score >= least[row]) & (q.ids[row] != chunk.ids[col])
    return _k_best(row[kept], chunk.ids[col[kept]], score[kept], k)


class Block:
    """A block of queries with the k best that it has found so far."""

    def __init__(self, queries: Turned, least: np.ndarray, k: int) -> None:
        self.queries, self.least, self.k = queries, least.copy(), k
        self.found = [(np.empty(0, np.int64),) * 3]
        self.fresh = 0

    def meet(self, chunk: Turned) -> None:
        if (chunk.longest * self.queries.length * (1 + 1e-9) < self.least).all():
            return
        self.found.append(best_in_chunk(self.queries, self.least, chunk, self.k))
        self.fresh += len(self.found[-1][0])
        if self.fresh > len(self.least):
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, vec_id, score) of the k best; their last scores are the
        thresholds from now on."""
        row, own, score = _k_best(*map(np.concatenate, zip(*self.found)), self.k)
        self.found, self.fresh = [(row, own, score)], 0
        counts = np.bincount(row, minlength=len(self.least))
        full = counts == self.k
        last = score[np.cumsum(counts)[full] - 1]
        self.least[full] = np.maximum(self.least[full], last)
        return row, own, score


def top_k(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """The ``k`` highest inner products of every query id with the rows of other ids.

    ``vectors`` has vec_id and v (array of whole numbers); ``queries`` is a
    condition on vec_id. Returns query_id, rank from 1, vec_id, score; ties go
    to the smaller vec_id; a query with fewer than ``k`` other rows has all.

    Rows with a null id or null v take no part. Rows that repeat a vec_id with
    another v, or both, each take part: as candidates (so an id may have several
    ranks) and as queries (the ``k`` best of all rows of the query's id). Shorter
    vectors count as padded with 0. An empty table gives an empty result. Scores must
    fit 64 bits. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    rows = durable(vectors.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
                   .select(F.col("vec_id").cast("long").alias("vec_id"), "v",
                           F.monotonically_increasing_id().alias("tag")), "topk-vectors")
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    asked = rows.filter(queries)
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, width)
    rotation = spark.sparkContext.broadcast(_rotation(rows, width))
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    # The tag spreads equal rows.
    by_length = [F.col("l2").desc(), F.col("vec_id"), F.col("tag")]
    sorted_rows = (rows.select("vec_id", "v", "tag", length.alias("l2"))
                   .repartitionByRange(_partitions(n, CHUNK, width), *by_length).sortWithinPartitions(*by_length))
    chunks = durable(_pack(sorted_rows, CHUNK, width), "topk-chunks")
    asked_parts = _partitions(n_asked, BLOCK, width)
    blocks = _pack(asked.repartitionByRange(asked_parts, "vec_id", "tag"), BLOCK, width)

    # The longest vectors, about SEEDS of them, and at most GRID norm boundaries.
    first, held = (0, 0), 0
    for c in chunks.orderBy("rank", "place").select("rank", "place", "n").limit(256).collect():
        if held >= SEEDS:
            break
        held, first = held + c["n"], (c["rank"], c["place"] + 1)
    first_rank = first[0]
    is_seed = (F.col("rank") < first_rank) | (F.col("rank") == first_rank) & (F.col("place") < first[1])
    seeds = [_unpack(c["ids"], c["values"], width)
             for c in chunks.filter(is_seed).select("ids", "values").collect()]
    last_rank = chunks.agg(F.max("rank")).first()[0]
    stride = last_rank // GRID + 1
    grid = [(c["rank"], c["longest"]) for c in chunks.filter(F.col("rank") % stride == 0)
            .groupBy("rank").agg(F.max("longest").alias("longest")).orderBy("rank").collect()]
    shipped = spark.sparkContext.broadcast(
        (np.concatenate([s[0] for s in seeds]), np.concatenate([s[1] for s in seeds]), grid))

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x, boundaries = shipped.value
        longest_vectors = Turned(ids, x, rotation.value)
        for batch in batches:
            for b in batch.to_pylist():
                queries = Turned(*_unpack(b["ids"], b["values"], width), rotation.value)
                block = Block(queries, np.full(len(queries.ids), -np.inf), k)
                block.meet(longest_vectors)
                row, own, score = block.best()
                # Vectors shorter than this reach no query's threshold.
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(block.least > 0, block.least / queries.length, 0.0).min() * (1 - 1e-9)
                to = next((r for r, longest in boundaries if longest < need), last_rank + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b["rank"]], pa.int32()), pa.array([b["place"]], pa.int32()), pa.array([to], pa.int32()),
                     *[pa.array([v], pa.binary()) for v in (
                         b["ids"], b["values"], block.least.tobytes(), queries.ids[row].tobytes(),
                         own.tobytes(), score.tobytes())]],
                    ["rank", "place", "to", "ids", "values", "least", "got_query", "got_id", "got_score"])

    seeded = durable(blocks.mapInArrow(
        seed, "rank int, place int, to int, ids binary, values binary, least binary, got_query binary, "
              "got_id binary, got_score binary"), "topk-seeded")

    def first_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b[c], np.int64)) for c in ("got_query", "got_id", "got_score")],
                    ["query_id", "vec_id", "score"])

    def more_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each unit the blocks come first, then the chunks, longest first."""
        def ended(blocks: list[Block]) -> Iterator[pa.RecordBatch]:
            for block in blocks:
                row, own, score = block.best()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.queries.ids[row]), pa.array(own), pa.array(score)],
                    ["query_id", "vec_id", "score"])

        unit, group = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1).to_pylist()[0]
                if b["unit"] != unit:
                    yield from ended(group)
                    unit, group = b["unit"], []
                turned = Turned(*_unpack(b["ids"], b["values"], width), rotation.value)
                if b["least"] is not None:
                    group.append(Block(turned, np.frombuffer(b["least"], np.float64), k))
                    continue
                for block in group:
                    block.meet(turned)
        yield from ended(group)

    # No join: its blocks times chunks would be rows of whole vectors, which Spark
    # takes to be as small as the blocks alone, and broadcasts. Only the copies
    # that the units need are made, and dealt to partitions by the unit.
    wanted = max(SPREAD, n * n_asked // WORK)
    groups = max(-(-n_asked // max(BLOCK, HELD // width)), min(asked_parts, math.isqrt(wanted) // 2))
    turns = -(-(last_rank + 1) * groups // wanted)
    stripes = -(-(last_rank + 1) // turns)
    group = F.col("rank") % groups
    # The ranks that a group's blocks need: one number for each group.
    reach = dict(seeded.groupBy(group).agg(F.max("to")).collect())
    waiting = (seeded.filter(F.col("to") > first_rank).withColumn("group", group).select(
        F.explode(F.transform(
            F.sequence(F.lit(first_rank), F.least(F.col("to"), F.lit(first_rank + stripes)) - 1),
            lambda rank: F.col("group") * stripes + rank % stripes)).alias("unit"),
        F.lit(-1).alias("rank"), "place", "ids", "values", "least"))
    needed = F.array(*[F.when(F.col("rank") < to, F.lit(g)) for g, to in sorted(reach.items())])
    coming = (chunks.filter(~is_seed).select(
        F.explode(F.transform(F.array_compact(needed),
                              lambda g: g * stripes + F.col("rank") % stripes)).alias("unit"),
        "rank", "place", "ids", "values", F.lit(None).cast("binary").alias("least")))
    parts = min(groups * stripes, MOST_PARTS)
    units = (waiting.unionByName(coming).repartitionById(parts, F.col("unit") % parts)
             .sortWithinPartitions("unit", "rank", "place"))
    found = (seeded.select("got_query", "got_id", "got_score").mapInArrow(first_found, FOUND)
             .unionByName(units.mapInArrow(more_found, FOUND)))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.select("*", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
