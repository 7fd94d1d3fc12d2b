"""The most similar vectors of every vector: balanced posting lists whose centroids are searched by a graph in memory.

A bounded sample of the vectors is split again and again by k-means until no part is larger than a list should be; the parts' means are
the centroids, and a graph of near centroids is kept in memory by every worker. Each vector is stored in the list of its nearest
centroid, and at a boundary also in those nearly as near; it asks the lists whose centroids are within a ratio of the nearest distance.
Lists are compared as blocks of a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from lexharbor.session import cut


#: Up to so many centroids a search keeps a table of those it has seen.
SEEN = 8192
#: Classes of copies that are sent to all tasks, at most, each with k + 1 items; and by how many salts more are joined.
MOST_SENT, SALTS = 10_000, 16


@dataclass(frozen=True)
class Setting:
    """What the index is built by. Every vector is indexed; only the centroids are fitted on a sample."""

    sample: int = 40_000  # vectors the centroids are fitted on, about; more where lists of list_size need more centroids
    most_sample: int = 1_000_000  # but no more than about so many, which is the bound of what the driver holds
    list_size: int = 400  # vectors a list should hold before replicas
    least_sample: int = 12  # of the sample in a list, at least, so that a mean is one
    degree: int = 24  # near centroids each centroid is linked to
    beam: int = 48  # centroids kept during a search of the graph
    replicas: int = 4  # lists a vector is stored in, at most
    store_ratio: float = 1.10  # stored where the distance is within this ratio of the least
    lists: int = 16  # lists a vector asks, at most
    ask_ratio: float = 1.22  # asked where the distance is within this ratio of the least
    block: int = 32_768  # stored vectors of a list compared by one task at a time, about
    ask_block: int = 65_536  # asking vectors of a list in one task, about
    measured: int = 10_000  # of the sample that the sizes of the lists are estimated by


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, as float32."""
    rows = rows.astype(np.float64)
    big = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / np.where(big > 0, big, 1)
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return (rows / np.where(norm > 0, norm, 1) + 0.0).astype(np.float32)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """The part of each row, by spherical k-means."""
    c = x[rng.choice(len(x), k, replace=False)]
    part = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        part = (x @ c.T).argmax(axis=1)
        sums = np.zeros((k, x.shape[1]), np.float64)
        np.add.at(sums, part, x)
        empty = ~np.any(sums, axis=1)
        if empty.any():
            sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        c = unit(sums)
    return (x @ c.T).argmax(axis=1)


@dataclass
class Lists:
    """The centroids, the graph between them, and where a search starts."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    blocks: np.ndarray | None = None  # of each list: into how many parts its stored vectors are divided
    ask_blocks: np.ndarray | None = None  # and its asking ones

    def measure(self, sample: np.ndarray, rows: int, s: Setting) -> None:
        """Sets the numbers of parts by what a part of the sample chooses. A wrong estimate makes parts larger or smaller, nothing else."""
        part = sample[: s.measured]
        _, lists, stored = self.choose(part, s)
        each = rows / max(len(part), 1)
        n = len(self.centroids)
        self.blocks = np.maximum(1, np.ceil(np.bincount(lists[stored], minlength=n) * each / s.block)).astype(np.int64)
        self.ask_blocks = np.maximum(1, np.ceil(np.bincount(lists, minlength=n) * each / s.ask_block)).astype(np.int64)

    def place(self, ids: np.ndarray, x: np.ndarray, asks: np.ndarray, s: Setting) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, d, q, role) of where each vector goes: role 1 stored, 2 asking, 3 both. A stored vector goes to one part of the list's
        stored and meets all parts of its asking ones; an asking vector the other way round."""
        row, lists, stored = self.choose(x, s)
        asks = asks[row]
        mixed = (ids[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        nd, nq = self.blocks[lists], self.ask_blocks[lists]
        d, q = (mixed % nd.astype(np.uint64)).astype(np.int64), (mixed % nq.astype(np.uint64)).astype(np.int64)
        whole = (nd == 1) & (nq == 1)
        out = []

        def add(at: np.ndarray, times: np.ndarray, which: str, role: np.ndarray) -> None:
            again = np.repeat(at, times[at])
            nth = np.arange(len(again)) - np.repeat(np.cumsum(times[at]) - times[at], times[at])
            out.append((row[again], lists[again], nth if which == "d" else d[again], nth if which == "q" else q[again], role[again]))

        role = stored + 2 * asks
        add(np.flatnonzero(whole & (role > 0)), np.ones_like(nd), "", role)
        add(np.flatnonzero(~whole & stored), nq, "q", np.ones_like(nd))
        add(np.flatnonzero(~whole & asks), nd, "d", np.full_like(nd, 2))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The up to `beam` nearest centroids of each row and their cosines, nearest first; -1 where there are fewer."""
        c, n = self.centroids, len(self.centroids)
        if n <= 2 * beam:  # all are linked to all
            cos = x @ c.T
            best = np.argsort(-cos, axis=1, kind="stable")[:, :beam]
            return best, np.take_along_axis(cos, best, 1)
        ids, cosines = [], []
        for lo in range(0, len(x), 2048):
            a, b = self._beam(x[lo : lo + 2048], beam)
            ids.append(a), cosines.append(b)
        return np.concatenate(ids), np.concatenate(cosines)

    def _beam(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        c, m = self.centroids, len(x)
        # A centroid that left the beam was farther than all in it and cannot come back, so that it is enough to know what is in the beam; where
        # centroids are few, a table of all that were seen is the faster way to the same.
        seen = np.zeros((m, len(c)), bool) if len(c) <= SEEN else None
        start = self.entries[:beam]
        ids = np.full((m, beam), -1, np.int64)
        cos = np.full((m, beam), -2, np.float32)
        ids[:, : len(start)] = start
        cos[:, : len(start)] = x @ c[start].T
        if seen is not None:
            seen[:, start] = True
        done = np.zeros((m, beam), bool)
        done[:, len(start) :] = True
        rows = np.arange(m)
        while len(rows):
            next_ = np.where(done[rows], -3, cos[rows]).argmax(axis=1)
            done[rows, next_] = True
            near = self.graph[ids[rows, next_]]
            if seen is not None:
                fresh = (near >= 0) & ~seen[rows[:, None], near]
                seen[rows[:, None], near] = True
            else:
                fresh = (near >= 0) & ~(near[:, :, None] == ids[rows][:, None, :]).any(axis=2)
            at, _ = np.nonzero(fresh)
            got = np.full(near.shape, -2, np.float32)
            got[fresh] = np.einsum("id,id->i", c[near[fresh]], x[rows[at]])
            all_cos = np.concatenate([cos[rows], got], axis=1)
            all_ids = np.concatenate([ids[rows], near], axis=1)
            all_done = np.concatenate([done[rows], ~fresh], axis=1)
            keep = np.argpartition(-all_cos, beam - 1, axis=1)[:, :beam]
            ids[rows], cos[rows] = np.take_along_axis(all_ids, keep, 1), np.take_along_axis(all_cos, keep, 1)
            done[rows] = np.take_along_axis(all_done, keep, 1)
            rows = rows[~done[rows].all(axis=1)]
        order = np.argsort(-cos, axis=1, kind="stable")
        ids, cos = np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)
        return np.where(cos > -2, ids, -1), cos

    def choose(self, x: np.ndarray, s: Setting) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, list, whether stored there) of each row's lists: those it asks, among them those it is stored in."""
        ids, cos = self.search(x, max(s.beam, s.lists))
        ids, cos = ids[:, : s.lists], cos[:, : s.lists]
        far = np.sqrt(np.maximum(2 - 2 * cos, 0)) + 1e-6
        ask = (ids >= 0) & (far <= far[:, :1] * s.ask_ratio)
        ask[:, 0] = True
        stored = ask & (far <= far[:, :1] * s.store_ratio)
        stored[:, s.replicas :] = False
        for j in range(1, min(s.replicas, ids.shape[1])):  # not in a list that is nearer to one chosen already than to the vector
            for i in range(j):
                apart = np.sqrt(np.maximum(2 - 2 * np.einsum("rd,rd->r", self.centroids[ids[:, i]], self.centroids[ids[:, j]]), 0))
                stored[:, j] &= ~(stored[:, i] & (apart < far[:, j]))
        stored[:, 0] = True
        rows, at = np.nonzero(ask)
        return rows, ids[rows, at], stored[rows, at]


def fit(sample: np.ndarray, rows: int, s: Setting, seed: int = 7) -> Lists:
    """The lists for `rows` vectors of which `sample` are known."""
    rng = np.random.default_rng(seed)
    most = max(s.least_sample, int(s.list_size * len(sample) / max(rows, 1)))
    leaves, tops, todo = [], [], [(np.arange(len(sample)), -1)]
    while todo:
        of, top = todo.pop()
        part = None
        if len(of) > most:
            part = _k_means(sample[of], min(16, -(-len(of) // most)), rng)
        if part is None or (part == part[0]).all():  # small enough, or nothing tells them apart
            tops.append(top)
            leaves.append(sample[of].sum(axis=0, dtype=np.float64))
        else:
            for p in np.unique(part):
                todo.append((of[part == p], p if top < 0 else top))
    c = unit(np.array(leaves))
    tops = np.array(tops)
    entries = np.array([np.flatnonzero(tops == t)[0] for t in np.unique(tops)])
    degree = min(s.degree, len(c) - 1)
    graph = np.full((len(c), degree + len(entries)), -1, np.int32)
    for lo in range(0, len(c), 1024):
        cos = c[lo : lo + 1024] @ c.T
        cos[np.arange(len(cos)), np.arange(lo, lo + len(cos))] = -2
        if degree:
            graph[lo : lo + 1024, :degree] = np.argpartition(-cos, degree - 1, axis=1)[:, :degree]
    for e in entries:  # both ways between a top part's entry and its members, so that all can be reached
        members = np.flatnonzero(tops == tops[e])
        graph[members[~(graph[members, :degree] == e).any(axis=1)], degree] = e
    return Lists(c, graph, entries)


def usable(df: DataFrame, dim: int, v: str = "v", dim_column: str | None = "embedding_dim") -> Column:
    """Whether the row has `dim` finite numbers in `v` that are not all 0 (and says so in `dim_column`)."""
    numbers = F.col(v)
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = (F.size(numbers) == dim) & finite & F.exists(numbers, lambda x: x != 0)
    return F.coalesce(ok & (F.col(dim_column) == dim) if dim_column else ok, F.lit(False))


@F.arrow_udf(BinaryType())
def _packed(vectors: pa.Array) -> pa.Array:
    n = len(vectors)
    if not n:
        return pa.array([], pa.binary())
    rows = unit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, -1))
    return pa.array([r.tobytes() for r in rows], pa.binary())


_KEPT: dict[int, Lists] = {}


def _lists(key: int, sent) -> Lists:
    """The lists of a broadcast, read once by a worker."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = sent.value
    return _KEPT[key]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, dim)


def _classes(rows: DataFrame, item: str, k: int) -> DataFrame:
    """unit, and ids: the k + 1 least items of the vectors that are equal in direction, or all if they are fewer."""
    w = Window.partitionBy("unit").orderBy(item)
    few = rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k + 1)
    return few.groupBy("unit").agg(F.array_sort(F.collect_list(item)).alias("ids"))


def similar(df: DataFrame, k: int = 5, dim: int = 64, item: str = "chunk_id", v: str = "v", dim_column: str | None = "embedding_dim", latest: str = "created_at", s: Setting = Setting(), exact: bool = False) -> DataFrame:
    """item, neighbour, cosine FLOAT, rank INT: for every item with a usable vector the `k` others of highest cosine, nearly always; always with
    `exact`, where each vector asks all lists, in blocks, in quadratic time.

    A usable vector has `dim` finite numbers that are not all 0; all others, and rows with a NULL item, are left out. Repeated rows of an
    item count once: the last by `latest` of its usable ones, then the greatest as packed bytes. Length does not matter. Equal cosines are ordered
    by the smaller item. With k or fewer usable vectors each item has all others; empty tables give no rows; other columns are not read.

    Vectors equal in direction are one class, searched once, of which k + 1 items are enough to answer: a third of all rows may be copies
    of one vector. Within a class the answer is exact. Approximate are only the lists that are asked; the lists themselves are compared
    whole, in blocks, however large one is. Sizes known to be bounded: the sample (`Setting.sample`), the centroids and their graph (no more
    than sample / least_sample of them), k + 1 items of a class, one block. A vector is shuffled once, to the lists it is in and asks.
    """
    spark = df.sparkSession
    names = {item: "item", v: "v", latest: "latest"}
    good = df.where(usable(df, dim, v, dim_column) & F.col(item).isNotNull()).select(*[F.col(a).alias(b) for a, b in names.items()])
    packed = good.select("item", F.struct("latest", _packed("v").alias("unit")).alias("row"))
    rows = cut(packed.groupBy("item").agg(F.max("row").alias("row")).select("item", F.col("row.unit").alias("unit")))
    classes = cut(_classes(rows, "item", k)).withColumn("id", F.monotonically_increasing_id())  # ids stay: the partitions are written
    n = classes.count()
    share = min(1.0, min(s.most_sample, max(s.sample, n * s.least_sample // s.list_size)) / max(n, 1))
    drawn = F.pmod(F.xxhash64("unit"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    picked = (classes.where(drawn) if share < 1 else classes).select("unit").toArrow().column("unit")
    empty = spark.createDataFrame([], "item string, neighbour string, cosine float, rank int")
    if not len(picked):
        return empty
    sample = _matrix(picked, dim)
    lists = fit(sample, n, s)
    if exact:
        s = replace(s, lists=len(lists.centroids), beam=len(lists.centroids), ask_ratio=float("inf"))
    lists.measure(sample, n, s)
    sent = spark.sparkContext.broadcast(lists)
    key = sent._jbroadcast.id()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, asks = batch.column(0).to_numpy(), np.asarray(batch.column(2).to_pylist(), bool)
                row, list_, d, q, role = _lists(key, sent).place(ids, _matrix(batch.column(1), dim), asks, s)
                at = pa.array(row)
                numbers = [pa.array(c.astype(np.int32)) for c in (list_, d, q)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *numbers, pa.array(role.astype(np.int8))], names=["id", "unit", "list", "d", "q", "role"])

    def compare(t: pa.Table) -> pa.Table:
        ids, role, x = t.column("id").to_numpy(), t.column("role").to_numpy(), _matrix(t.column("unit"), dim)
        d, q = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        d = d[np.argsort(ids[d])]
        out = [[], [], []]
        top = min(k + 1, len(d))  # one more, as a vector meets itself
        step = max(16, min(1024, 8_000_000 // max(len(d), 1)))
        for lo in range(0, len(q) if top else 0, step):
            part = q[lo : lo + step]
            cos = x[part] @ x[d].T
            best = np.argpartition(-cos, top - 1, axis=1)[:, :top]
            out[0].append(np.repeat(ids[part], top)), out[1].append(ids[d][best].ravel()), out[2].append(np.take_along_axis(cos, best, 1).ravel())
        a, b, c = [np.concatenate(o) if o else np.zeros(0) for o in out]
        other = a != b
        return pa.table({"a": a[other].astype(np.int64), "b": b[other].astype(np.int64), "cosine": c[other].astype(np.float32)})

    # a class of more than k items has its neighbours within itself; it is stored, and asks nothing
    of_class = classes.select("id", "unit", (F.size("ids") <= k).alias("asks"))
    placed = of_class.mapInArrow(place, "id long, unit binary, list int, d int, q int, role byte")
    met = placed.groupBy("list", "d", "q").applyInArrow(compare, "a long, b long, cosine float")
    by_a = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    nearest = met.repartition("a").groupBy("a", "b").agg(F.max("cosine").alias("cosine")).withColumn("n", F.row_number().over(by_a)).where(F.col("n") <= k).drop("n")

    ids = classes.select("id", "ids")
    asked = ids.where(F.size("ids") <= k).select(F.col("id").alias("a"), F.col("ids").alias("from"))
    found = nearest.join(asked, "a").join(ids.select(F.col("id").alias("b"), F.col("ids").alias("to")), "b")
    found = found.select("a", "from", "cosine", F.explode("to").alias("neighbour"))
    by_cosine = Window.partitionBy("a").orderBy(F.desc("cosine"), "neighbour")
    other = found.withColumn("n", F.row_number().over(by_cosine)).where(F.col("n") <= k + 1 - F.size("from"))
    other = other.select(F.explode("from").alias("item"), "neighbour", "cosine", (F.col("n") + F.size("from") - 1).alias("rank"))

    # items of one class: the least others. A class of no more than k items holds them all; of a larger one, which may hold a third of all
    # rows, the items are found by its digest: where such classes are few they are sent to the items, else the join is salted.
    small = classes.where(F.size("ids").between(2, k)).select(F.explode("ids").alias("item"), "ids")
    digest = F.unhex(F.md5("unit")).alias("unit")
    large = classes.where(F.size("ids") > k).select(digest, "ids")
    own = rows.select("item", digest)
    if large.limit(MOST_SENT + 1).count() <= MOST_SENT:
        mine = own.join(F.broadcast(large), "unit")
    else:
        salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        mine = own.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)).cast("int")).join(salted, ["unit", "salt"])
    least = F.slice(F.filter("ids", lambda x: x != F.col("item")), 1, k)
    equal = small.unionByName(mine.select("item", "ids")).select("item", F.posexplode(least).alias("rank", "neighbour"))
    equal = equal.select("item", "neighbour", F.lit(1.0).cast("float").alias("cosine"), (F.col("rank") + 1).alias("rank"))
    return equal.unionByName(other)


def pairs(neighbours: DataFrame, item: str = "chunk_id") -> DataFrame:
    """<item>_a < <item>_b: the pairs of which one is among the neighbours of the other, once each."""
    ends = neighbours.select(F.least("item", "neighbour").alias(f"{item}_a"), F.greatest("item", "neighbour").alias(f"{item}_b"))
    return ends.distinct()
