"""Embedding near-dedup with coarse inverted lists and product-quantised residuals.

A coarse codebook splits the unit vectors into inverted lists; the residual to the list's centroid is coded by one of
256 codewords in each subspace. Both codebooks are fitted on a bounded sample, every row is indexed. A vector that
links with a query can only lie in a list whose border with the query's own list is within the linking radius r. The border
lies between the two, so their distances to it add up to r at most and one of them is within r / 2: every vector probes
the lists with a border within r / 2, and a pair counts whichever side finds it. No pair within the radius is lost, however
the vectors are spread over the dimensions. Inside a list, asymmetric distances from the query to the coded vectors are sums
of table look-ups; as a code's error is stored, the triangle inequality tells which vectors may lie within the radius, and
only those get the exact cosine in double precision.

Equal vectors are one class. The number of lists grows with the vectors, and the members and the queries of a list are both
split into blocks of bounded size, met pair by pair; a pair of blocks answers with one row per query (its number of
links and the smallest member of its component there), so links inside a dense group are counted but never emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewkit.llm.components import components, stored
from reviewkit.session import ship_package

#: Rows the codebooks are fitted on (smallest id hash), at least; more lists take ``PER_LIST`` rows each.
SAMPLE, PER_LIST = 20_000, 8
#: Coarse lists at least (one for every ``BLOCK`` vectors), subspaces, and codewords of a subspace.
LISTS, SUBSPACES, CODES = 256, 8, 256
#: Members and queries of a pair of blocks, about; queries compared with a block at once.
BLOCK, QUERIES, STRIP = 2_000, 8_000, 512
#: Cells of the matrix of rows by lists that is held at once.
CELLS = 1 << 22
#: Borders of ``Codebook.probes``, in mean-square steps of the radius towards a border.
SIGMAS = 3.6
#: Rounding of distances between unit vectors in double precision, added to every bound.
SLACK = 1e-6


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from k rows drawn without replacement; an empty cell keeps its centre."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centre = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        step = max(1, CELLS // k)
        of = np.concatenate([nearest(x[i:i + step], centre)[0] for i in range(0, len(x), step)])
        n = np.bincount(of, minlength=k)
        total = np.stack([np.bincount(of, x[:, d], k) for d in range(x.shape[1])], 1)
        centre[n > 0] = total[n > 0] / n[n > 0, None]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distances to all) of the nearest centre of each row."""
    d = (x ** 2).sum(1)[:, None] - 2 * x @ centre.T + (centre ** 2).sum(1)[None, :]
    return d.argmin(1), np.maximum(d, 0)


class Codebook:
    """Coarse centroids and the subspace codewords of residuals."""

    def __init__(self, sample: np.ndarray, lists: int = LISTS) -> None:
        self.dim = sample.shape[1]
        self.coarse = kmeans(sample, max(1, min(lists, len(sample) // PER_LIST)))
        rest = np.concatenate([part - self.coarse[nearest(part, self.coarse)[0]] for part in self.strips(sample[:SAMPLE])])
        self.cuts = np.linspace(0, self.dim, min(SUBSPACES, self.dim) + 1).astype(int)
        self.words = [kmeans(rest[:, a:b], CODES, 6) for a, b in zip(self.cuts, self.cuts[1:])]

    def strips(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """Rows, as many at a time as ``CELLS`` allows."""
        step = max(1, CELLS // len(self.coarse))
        for i in range(0, len(x), step):
            yield x[i:i + step]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and residual error of each row, and all squared coarse distances."""
        of, far = nearest(x, self.coarse)
        rest = x - self.coarse[of]
        codes = np.stack([nearest(rest[:, a:b], w)[0] for a, b, w in zip(self.cuts, self.cuts[1:], self.words)], 1)
        return of, codes.astype(np.uint8), np.sqrt(((rest - self.decode(codes)) ** 2).sum(1)), far

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([w[codes[:, i]] for i, w in enumerate(self.words)], 1)

    def probes(self, of: np.ndarray, far: np.ndarray, radius: float) -> list[np.ndarray]:
        """``bordering`` for a radius that assumes differences spread evenly over the dimensions. An estimate: it loses pairs of
        anisotropic vectors, and ``near_vectors`` does not use it."""
        return self.bordering(of, far, radius * min(1.0, SIGMAS / np.sqrt(self.dim)))

    def bordering(self, of: np.ndarray, far: np.ndarray, reach: float) -> list[np.ndarray]:
        """Lists with a border within ``reach``, the own one included. A vector within ``reach`` is nearer to its own centroid
        than to the query's, so its list is one of them."""
        home, at = np.unique(of, return_inverse=True)
        gap = np.sqrt(nearest(self.coarse[home], self.coarse)[1])[at]
        beyond = (far - far[np.arange(len(of)), of][:, None]) / (2 * np.maximum(gap, 1e-12))
        ok = beyond <= reach + SLACK
        ok[np.arange(len(of)), of] = True
        return [np.flatnonzero(row) for row in ok]

    def distances(self, query: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to coded vectors of one list, by table look-up."""
        rest = query - self.coarse[cell]
        total = np.zeros((len(query), len(codes)), np.float32)
        for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            table = nearest(rest[:, a:b], self.words[i])[1].astype(np.float32)
            total += table[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of the binary column of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.sqrt((x ** 2).sum(1, keepdims=True))


def _vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vec, dim): the components as bytes of doubles; vec null if the vector links with nothing."""
    schema = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary()), ("dim", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column(1).to_pylist():
                x = None if v is None else np.array([np.nan if c is None else c for c in v], np.float64)
                out.append(None if x is None or not len(x) or not np.isfinite(x).all() or not x.any() else (x + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()),
                                              pa.array([len(v) // 8 if v else 0 for v in out], pa.int32())], schema=schema)

    return embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        run, "vec_id long, vec binary, dim int")


INDEX = pa.schema([("cls", pa.binary()), ("copies", pa.int64()), ("vec", pa.binary()), ("cell", pa.int32()),
                   ("codes", pa.binary()), ("error", pa.float64()), ("probe", pa.list_(pa.int32()))])
ANSWER = pa.schema([("u", pa.binary()), ("v", pa.binary()), ("links", pa.int64())])


def _answer(members: pa.Table, queries: pa.Table, book: Codebook, cosine: float) -> pa.Table:
    """Links of one block of a list's queries with one block of its members."""
    if not members.num_rows or not queries.num_rows:
        return ANSWER.empty_table()
    cell = members.column("cell")[0].as_py()
    x, q = _unit(_matrix(members.column("vec"), book.dim)), _unit(_matrix(queries.column("vec"), book.dim))
    codes = np.frombuffer(b"".join(members.column("codes").to_pylist()), np.uint8).reshape(len(x), -1)
    error = members.column("error").to_numpy()
    homes, home = np.unique(queries.column("home").to_numpy(), return_inverse=True)
    asks = np.zeros((len(x), len(homes)), bool)  # which of the queries' lists each member probes itself
    probe = members.column("probe").combine_chunks()
    asker, asked_list = np.repeat(np.arange(len(x)), probe.value_lengths().to_numpy()), probe.flatten().to_numpy()
    at_home = np.minimum(np.searchsorted(homes, asked_list), len(homes) - 1)
    met = homes[at_home] == asked_list
    asks[asker[met], at_home[met]] = True
    copies, own = members.column("copies").to_numpy(), queries.column("copies").to_numpy()
    name, asked = members.column("cls").to_pylist(), queries.column("cls").to_pylist()
    radius = np.sqrt(max(0.0, 2 - 2 * cosine))
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in range(0, len(q), STRIP):
        part = q[i:i + STRIP]
        near = book.distances(part, cell, codes) <= radius + error[None, :] + 1e-3  # single precision
        rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
        if len(rows):
            exact = part[rows] @ x[cols].T
            r, c = np.nonzero(near[np.ix_(rows, cols)] & (exact >= cosine))
            a.append(rows[r] + i)
            b.append(cols[c])
    a, b = np.concatenate(a), np.concatenate(b)
    at = {n: i for i, n in enumerate(name)}
    same = np.array([at.get(n, -1) for n in asked])
    other = same[a] != b
    a, b = a[other], b[other]
    links = np.bincount(a, copies[b], len(q)).astype(np.int64)
    # A member that probes the query's list counts the link there, as a query; one that does not counts it here.
    here = ~asks[b, home[a]]
    back = np.bincount(b[here], own[a[here]], len(x)).astype(np.int64)
    # Components of the queries and members that meet here; a query that is a member is one node.
    node_q = np.where(same >= 0, same, len(name) + np.arange(len(asked)))
    label = np.arange(len(name) + len(asked))
    u, v = node_q[a], b
    while len(u):
        now = label.copy()
        np.minimum.at(now, u, label[v])
        np.minimum.at(now, v, label[u])
        now = now[now]
        if (now == label).all():
            break
        label = now
    names = name + asked
    edges = [(asked[i], names[label[node_q[i]]], int(links[i])) for i in np.flatnonzero(links)]
    # Members tie to the same heads.
    edges += [(name[i], names[label[i]], int(back[i])) for i in np.unique(b) if label[i] != i or back[i]]
    return pa.Table.from_pydict(dict(zip(ANSWER.names, zip(*edges))) if edges else {k: [] for k in ANSWER.names}, schema=ANSWER)


def _lists(vectors: int) -> int:
    """Coarse lists for so many distinct vectors: about ``BLOCK`` each."""
    return max(LISTS, -(-vectors // BLOCK))


def _book(classes: DataFrame, dim: int, vectors: int) -> Codebook | None:
    lists = _lists(vectors)
    rows = (classes.where(F.col("dim") == dim).orderBy(F.xxhash64("cls"), "cls").limit(max(SAMPLE, PER_LIST * lists))
            .select("cls").collect())
    return Codebook(_unit(np.frombuffer(b"".join(r.cls for r in rows), np.float64).reshape(-1, dim)), lists) if rows else None


def near_vectors(embeddings: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Vectors whose cosine is at least ``cosine``, and their components.

    Links are all such pairs (see the module). ``embeddings`` needs ``vec_id`` and ``embedding``. Returns one row per vector: vec_id, n_links (other vectors linked
    directly), component_id (smallest vec_id reachable, itself included), kept (vec_id = component_id).

    Null, empty and zero vectors and those with a null or non-finite component link with nothing. Vectors of different
    lengths do not link. A null vec_id takes part in links; its component is the smallest id there, null if there is none, and it
    is not kept. Repeated rows are vectors of their own. Other columns are ignored; an empty table gives an empty result.

    Scale: the codebooks go to the executors; their sample, ``PER_LIST`` vectors a list, is fitted on the driver. Every
    distinct vector moves to its own list and, as a query, to the lists it probes. There about ``BLOCK`` members meet
    about ``QUERIES`` queries at a time, so a list of any size, however many probe it, is many bounded groups.
    """
    ship_package(embeddings.sparkSession)
    named = stored(_vectors(embeddings), "vectors")
    classes = stored(named.where("vec is not null").groupBy(F.col("vec").alias("cls")).agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim")), "classes")
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    answers = None
    for dim, vectors in classes.groupBy("dim").count().orderBy("dim").collect():
        found = _answers(classes.where(F.col("dim") == dim), _book(classes, dim, vectors), cosine, radius)
        answers = found if answers is None else answers.union(found)
    if answers is None:
        return named.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.col("vec_id").isNotNull().alias("kept"))
    answers = stored(answers, "answers")
    joined = components(answers.select("u", "v"))
    least = stored(joined.join(classes, joined.node == classes.cls).groupBy("component").agg(F.min("id").alias("least")), "least")
    tied = joined.join(least, "component").select(F.col("node").alias("cls"), "least")
    links = answers.groupBy(F.col("u").alias("cls")).agg(F.sum("links").alias("links"))
    # Stored, so that both sides of the last join are plain shuffles: a vector with many copies is split.
    classed = stored(classes.join(tied, "cls", "left").join(links, "cls", "left")
                     .select("cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                             F.coalesce("least", "id").alias("component")), "classed")
    return (named.join(classed, named.vec == classed.cls, "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _answers(classes: DataFrame, book: Codebook, cosine: float, radius: float) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(book)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b_ = shared.value
        for b in batches:
            at = 0
            for x in b_.strips(_unit(_matrix(b.column(0), b_.dim))) if b.num_rows else ():
                of, codes, error, far = b_.encode(x)
                part = b.slice(at, len(x))
                at += len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(0), pa.array(of, pa.int32()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array([p.tolist() for p in b_.bordering(of, far, radius / 2)], pa.list_(pa.int32()))], schema=INDEX)

    indexed = stored(classes.select("cls", "copies").mapInArrow(
        index, "cls binary, copies long, vec binary, cell int, codes binary, error double, probe array<int>"), "index")
    blocks = indexed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    strips = (indexed.select(F.explode("probe").alias("cell")).groupBy("cell")
              .agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("strips")))
    sizes = F.broadcast(stored(blocks.join(strips, "cell"), "sizes"))  # a row per list
    members = (indexed.join(sizes, "cell").withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
               .withColumn("strip", F.explode(F.sequence(F.lit(0), F.col("strips") - 1))))
    queries = (indexed.select(F.col("cls").alias("cls"), F.col("copies").alias("copies"), F.col("vec").alias("vec"),
                              F.col("cell").alias("home"), F.explode("probe").alias("cell")).join(sizes, "cell")
               .withColumn("strip", F.pmod(F.xxhash64("cls"), F.col("strips")).cast("int"))
               .withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return (members.select("cell", "blk", "strip", "cls", "copies", "vec", "codes", "error", "probe").groupBy("cell", "blk", "strip")
            .cogroup(queries.select("cell", "blk", "strip", "cls", "copies", "vec", "home").groupBy("cell", "blk", "strip"))
            .applyInArrow(lambda m, q: _answer(m, q, shared.value, cosine), "u binary, v binary, links long"))
