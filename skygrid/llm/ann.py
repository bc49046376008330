"""Approximate nearest neighbours by cosine: inverted lists, scanned dimension by dimension.

The unit vectors are turned by one random rotation, and each half of their coordinates is
quantised by centres of its own; a list is a pair of centres, so the number of lists grows with
the table (as the root of its rows) while the sample that centres are fitted on stays bounded (``sample_rows``,
chosen by a hash of the id; of small tables an eighth). How many lists a query probes is measured: one scan of all rows finds the true
neighbours of a few hundred rows of the sample, and so many lists are probed that the share ``recall`` of these is in them. The sample also gives
every query an upper bound of its k-th distance, from the sample's rows in the lists that it probes. All answers come from the lists.

All vectors are assigned to lists, and each list is cut into blocks of bounded size, so that a list that holds
a third of all vectors is many tasks. Of equal vectors only the k + 1 smallest ids
are candidates, as ties go to the smaller id: no other can be among the k nearest of anything.

After the rotation any few coordinates are a fair sample of all. Within a block
columns are scanned in groups: after the first d of D coordinates a candidate goes on only if its partial squared distance, times D / d,
is not above bound * (1 + EPSILON / sqrt(d)) ** 2, a test of the hypothesis that its distance is within the
bound. The few that pass all tests are scored exactly on the vectors as given. Rows of the sample
are not abandoned before their whole distance is known, so that every query finds k.

Ties go to the smaller id. Defined cases
- ids null, and vectors null, empty, zero, of another length than the commonest, or with null
  or non-finite components take no part, as queries or candidates
- fewer candidates than k: all of them
- repeated ids: one candidate, with its best row; a query's own id is none
- an empty table: no rows; extra columns are ignored, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, written

#: Candidates that a task holds at most; twice the usual list, if that is less.
BLOCK_ROWS = 4096
#: Doubt of the tests: a larger one abandons later.
EPSILON = 2.1
COLUMNS = 16
#: Centres of a half; lists are at most its square.
MOST_CENTRES = 512
#: Rows of the sample whose neighbours among all rows say how many lists to probe.
ASKED = 256
#: Queries that are routed or scanned at a time, and numbers in a matrix of queries and lists.
CHUNK, CELLS = 256, 1 << 22


@dataclass
class Index:
    """What routing needs; its size is bounded by sample_rows."""

    rotation: np.ndarray
    centres: tuple[np.ndarray, np.ndarray]
    probes: int
    sample: np.ndarray  # turned unit vectors
    sample_ids: np.ndarray
    sample_lists: np.ndarray
    k: int
    block_rows: int

    @property
    def lists(self) -> int:
        return len(self.centres[0]) * len(self.centres[1])

    def distances(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each half to its centres, but for what is the same for all."""
        cut = self.centres[0].shape[1]
        return tuple((c * c).sum(axis=1) - 2 * (x @ c.T) for x, c in zip((turned[:, :cut], turned[:, cut:]), self.centres, strict=True))  # type: ignore[return-value]

    def list_of(self, turned: np.ndarray) -> np.ndarray:
        first, second = self.distances(turned)
        return first.argmin(axis=1) * len(self.centres[1]) + second.argmin(axis=1)

    def closeness(self, turned: np.ndarray) -> np.ndarray:
        """Distance of each row to each list."""
        first, second = self.distances(turned)
        return (first[:, :, None] + second[:, None, :]).reshape(len(turned), -1)

    def chunks(self, rows: int) -> Iterator[slice]:
        step = max(1, min(CHUNK, CELLS // self.lists))
        for a in range(0, rows, step):
            yield slice(a, a + step)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small numbers stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v: rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    rows = rows.where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    # The longer one, if two lengths are equally common.
    common = rows.groupBy(F.size("v").alias("length")).count().agg(F.max_by("length", F.struct("count", "length"))).first()[0]
    return rows.where(F.size("v") == F.lit(common))


def centred(x: np.ndarray, centres: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of x by a few rounds of k-means."""
    out = x[rng.choice(len(x), centres, replace=False)]
    for _ in range(8):
        own = ((out * out).sum(axis=1) - 2 * (x @ out.T)).argmin(axis=1)
        sums, n = np.zeros_like(out), np.bincount(own, minlength=centres)
        np.add.at(sums, own, x)
        out[n > 0] = sums[n > 0] / n[n > 0, None]
    return out


def trained(rows: DataFrame, k: int, sample_rows: int, lists: int | None, seed: int) -> Index | None:
    total = rows.count()
    size = min(sample_rows, max(256, total // 8))
    # By id, so that an id that repeats is drawn once.
    drawn = rows.select("vec_id").distinct().orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(size)
    picked = rows.join(F.broadcast(drawn), "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v")).toArrow().sort_by("vec_id").combine_chunks()
    if not picked.num_rows:
        return None
    rng = np.random.default_rng(seed)
    ids, given = picked.column("vec_id").to_numpy(), matrix(picked.column("v").combine_chunks())
    rotation = np.linalg.qr(rng.standard_normal((given.shape[1],) * 2))[0]
    sample = unit(given) @ rotation
    centres = min(MOST_CENTRES, max(1, len(sample) // 16), int(np.ceil((lists or total**0.5) ** 0.5)))
    cut = given.shape[1] // 2
    halves = [centred(x, centres if x.shape[1] else 1, rng) for x in (sample[:, :cut], sample[:, cut:])]
    index = Index(rotation, (halves[0], halves[1]), 1, sample, ids, np.zeros(len(ids), np.int64), k, BLOCK_ROWS)
    index.block_rows = min(BLOCK_ROWS, max(64, 2 * total // index.lists))
    index.sample_lists = index.list_of(sample)
    return index


def neighbours_of_sample(assigned: DataFrame, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """For ASKED rows of the sample the lists of their k nearest of all rows assigned(list, vec_id, v), by one scan; and which row each is for.

    A task keeps k of each, so few rows leave it.
    """
    asked, ids, k = index.sample[:ASKED], index.sample_ids[:ASKED], index.k
    shared = assigned.sparkSession.sparkContext.broadcast((index.rotation, asked, ids))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation, asked, ids = shared.value
        score, own, where = np.full((len(asked), k), -np.inf), np.full((len(asked), k), -1), np.full((len(asked), k), -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            given = batch.column("vec_id").to_numpy()
            near = asked @ (unit(matrix(batch.column("v"))) @ rotation).T
            near[ids[:, None] == given[None, :]] = -np.inf
            both = np.concatenate([score, near], axis=1)
            best = np.argpartition(-both, k - 1, axis=1)[:, :k]
            score = np.take_along_axis(both, best, axis=1)
            own = np.take_along_axis(np.concatenate([own, np.broadcast_to(given, near.shape)], axis=1), best, axis=1)
            where = np.take_along_axis(np.concatenate([where, np.broadcast_to(batch.column("list").to_numpy(), near.shape)], axis=1), best, axis=1)
        row, col = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(own[row, col]), pa.array(where[row, col].astype(np.int32)), pa.array(score[row, col])], ["asked", "vec_id", "list", "score"])

    found = mapped(assigned.select("list", "vec_id", "v"), work, "asked long, vec_id long, list int, score double")
    best = Window.partitionBy("asked").orderBy(F.col("score").desc(), "vec_id")
    rows = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("asked", "list").collect()
    return np.array([r["asked"] for r in rows], np.int64), np.array([r["list"] for r in rows], np.int64)


def probes_for(assigned: DataFrame, index: Index, recall: float) -> int:
    """Lists that a query has to probe to find that share of its true neighbours."""
    row, where = neighbours_of_sample(assigned, index)
    if not len(row):
        return 1
    needed = []
    for part in index.chunks(min(ASKED, len(index.sample))):
        far = index.closeness(index.sample[:ASKED][part])
        mine = np.flatnonzero((row >= part.start) & (row < part.start + len(far)))
        needed += [int((far[row[i] - part.start] <= far[row[i] - part.start, where[i]]).sum()) for i in mine]
    return int(np.quantile(needed, recall, method="higher"))


def routes(index: Index, ids: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, list) pairs to scan, and each query's bound: the k-th squared distance of the sample's rows in its lists."""
    who, where, bounds = [], [], np.full(len(ids), 4.0)
    for part in index.chunks(len(ids)):
        far = index.closeness(turned[part])
        probed = np.zeros(far.shape, bool)
        np.put_along_axis(probed, np.argpartition(far, index.probes - 1, axis=1)[:, : index.probes], True, axis=1)
        distance = 2 - 2 * (turned[part] @ index.sample.T)
        distance[ids[part][:, None] == index.sample_ids[None, :]] = np.inf
        for i in np.flatnonzero((probed[:, index.sample_lists] & np.isfinite(distance)).sum(axis=1) < index.k):
            # More lists, up to those that hold k of the sample.
            others = np.isfinite(distance[i])
            reach = np.sort(far[i, index.sample_lists[others]])
            probed[i] |= far[i] <= (reach[index.k - 1] if len(reach) >= index.k else np.inf)
        distance[~probed[:, index.sample_lists]] = np.inf
        if len(index.sample_ids) >= index.k:
            bounds[part] = np.minimum(4.0, np.partition(distance, index.k - 1, axis=1)[:, index.k - 1])
        row, list_ = np.nonzero(probed)
        who.append(row + part.start)
        where.append(list_)
    return np.concatenate(who), np.concatenate(where), bounds


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def scan_block(index: Index, ids: np.ndarray, given: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of a block's best k for each query, within the bounds (squared distances)."""
    turned, asked = unit(given) @ index.rotation, unit(queries) @ index.rotation
    sampled = np.isin(ids, index.sample_ids)
    size = turned.shape[1]
    columns = [np.ascontiguousarray(turned[:, c : c + COLUMNS]) for c in range(0, size, COLUMNS)]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first in range(0, len(queries), CHUNK):
        part = slice(first, first + CHUNK)
        parts = [asked[part, c : c + COLUMNS] for c in range(0, size, COLUMNS)]
        # The first columns for all pairs, the others for those that are left.
        partial = (columns[0] ** 2).sum(axis=1)[:, None] + (parts[0] ** 2).sum(axis=1) - 2 * (columns[0] @ parts[0].T)
        row, col = np.nonzero((partial <= _limit(bounds[part], min(COLUMNS, size), size)) | sampled[:, None])
        left = partial[row, col]
        for j in range(1, len(columns)):
            left = left + ((columns[j][row] - parts[j][col]) ** 2).sum(axis=1)
            keep = (left <= _limit(bounds[part], min(COLUMNS * (j + 1), size), size)[col]) | sampled[row]
            row, col, left = row[keep], col[keep], left[keep]
        keep = (ids[row] != query_ids[part][col]) & (left <= _limit(bounds[part], size, size)[col])
        row, col = row[keep], col[keep] + first
        score = cosines(given[row], queries[col])
        order = np.lexsort((ids[row], -score, col))
        row, col, score = row[order], col[order], score[order]
        place = np.arange(len(col)) - np.searchsorted(col, col)
        best = place < index.k
        found.append((query_ids[col[best]], ids[row[best]], score[best]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))  # type: ignore[return-value]


def _limit(bound: np.ndarray, seen: int, size: int) -> np.ndarray:
    slack = 1.0 if seen == size else (1 + EPSILON / seen**0.5) ** 2
    return bound * slack * seen / size + 1e-9


def indexed(rows: DataFrame, k: int, sample_rows: int, lists: int | None, recall: float, seed: int) -> tuple[Index | None, DataFrame | None]:
    """The index of rows(vec_id, v), and the written table of list, vec_id, v."""
    index = trained(rows, k, sample_rows, lists, seed)
    if index is None:
        return None, None
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = shared.value.list_of(unit(matrix(batch.column("v"))) @ shared.value.rotation)
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *batch.columns], ["list", "vec_id", "v"])

    first = Window.partitionBy("v").orderBy("vec_id")
    candidates = rows.dropDuplicates(["vec_id", "v"]).withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).drop("place")
    assigned = written(mapped(candidates, assign, "list int, vec_id long, v array<double>"))
    index.probes = probes_for(assigned, index, recall)
    return index, assigned


def scanned_share(vectors: DataFrame, is_query: Column, k: int = 5, sample_rows: int = 8192, lists: int | None = None, recall: float = 0.975, seed: int = 0, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Share of all candidates that lie in the lists which a query probes, on average."""
    rows = usable(vectors, id_col, vector_col)
    index, assigned = indexed(rows, k, sample_rows, lists, recall, seed)
    if index is None:
        return 0.0
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, names, _ = routes(shared.value, batch.column("vec_id").to_numpy(), unit(matrix(batch.column("v"))) @ shared.value.rotation)
                list_, n = np.unique(names, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(list_.astype(np.int32)), pa.array(n)], ["list", "queries"])

    sizes = assigned.groupBy("list").agg(F.count("*").alias("n"))
    queries = rows.where(is_query)
    met = mapped(queries, route, "list int, queries long").groupBy("list").agg(F.sum("queries").alias("queries")).join(sizes, "list")
    pairs = met.agg(F.sum(F.col("queries") * F.col("n"))).first()[0] or 0
    return pairs / max(1, queries.count() * assigned.count())


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, sample_rows: int = 8192, lists: int | None = None, recall: float = 0.975, seed: int = 0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row where is_query holds (a condition on vec_id)."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    index, assigned = indexed(rows, k, sample_rows, lists, recall, seed)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each list and batch of queries, with the queries that probe it."""
        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            given, ids = matrix(batch.column("v")), batch.column("vec_id").to_numpy()
            who, names, bound = routes(index, ids, unit(given) @ index.rotation)
            order = np.argsort(names, kind="stable")
            who, names = who[order], names[order]
            cuts = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
            groups = [who[a:b] for a, b in zip(cuts, [*cuts[1:], len(who)], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[cuts].astype(np.int32)), *[pa.array([x[g].tobytes() for g in groups], pa.binary()) for x in (ids.astype("<i8"), given, bound)]], ["list", "query_ids", "queries", "bounds"]
            )

    def scan(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        given = matrix(left.column("v").combine_chunks())
        packed = [np.frombuffer(b"".join(right.column(c).to_pylist()), kind) for c, kind in (("query_ids", "<i8"), ("queries", np.float64), ("bounds", np.float64))]
        q, x, s = scan_block(shared.value, left.column("vec_id").to_numpy(), given, packed[0], packed[1].reshape(-1, given.shape[1]), packed[2])
        return pa.table({"query_id": q, "vec_id": x, "score": s})

    blocks = assigned.groupBy("list").agg(F.ceil(F.count("*") / index.block_rows).cast("int").alias("blocks"))
    cells = assigned.join(F.broadcast(blocks), "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    routed = mapped(rows.where(is_query), route, "list int, query_ids binary, queries binary, bounds binary")
    routed = routed.join(F.broadcast(blocks), "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    found = (
        cells.select("list", "block", "vec_id", "v").groupBy("list", "block").cogroup(routed.select("list", "block", "query_ids", "queries", "bounds").groupBy("list", "block")).applyInArrow(scan, "query_id long, vec_id long, score double")
    )
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
