"""Near-duplicate embeddings by a subspace pigeonhole join.

Vectors are scaled to length one, turned by a fixed random rotation (so no direction of the
data falls into one block) and split into blocks of a few dimensions. Two vectors within a
squared distance T of each other are, in at least one block, within that block's share of T
(its share of the dimensions). So every block is range-joined on its own under its share, and
the union of what the blocks find holds every near pair; a pair counts in the first block that
finds it, and is verified over all blocks there.

A range join runs in regions. Labels of up to REGION_ROWS rows are one region of each block;
larger ones are cut into grid cells of twice the block's radius along its first axes (as many
as the label's rows need), and a row also visits the later cells that its radius reaches.
A cell that still holds more rows, near copies mostly, is dealt to pairs of row chunks. In a
region, leaves of neighbouring rows whose boxes are too far apart are skipped.

Coordinates are rounded to 16 bits, so the squared distance of two rows is an exact integer
whose error against the true distance has a bound. Pairs beyond that error decide themselves;
the few within it are looked up and decided by their cosine in double precision. Links are
counted and components joined inside the regions, so no list of pairs leaves them.

Defined results: vectors that are NULL, empty, zero, or hold a NULL or non-finite component,
and those with a NULL label, link with nothing; so do vectors of different lengths. Equal
vectors of one label are one node, expanded at the end. A NULL id takes part: its component is
the smallest id that links reach, NULL if there is none. Rows of one id are separate rows.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import materialize, offsets_of, schema_with
from loanmart.llm.jaccard import components

#: Dimensions of a block, about.
BLOCK_DIMS = 16
#: Rows of a label, or of a grid cell, that one task compares.
REGION_ROWS = 250_000
#: Rows compared with others at once, and candidates verified at once.
LEAF_ROWS, TILE_ROWS, SLICE = 1024, 4096, 50_000
#: Labels or cells beyond REGION_ROWS whose list may be broadcast.
MOST_BROADCAST = 100_000
#: Length of a unit vector in rounded coordinates.
SCALE = 32767


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))[0]


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Budget:
    """Blocks of a vector length and squared distances, in rounded coordinates."""

    def __init__(self, dims: int, cosine: float, block_dims: int):
        self.dims = dims
        sizes = [len(p) for p in np.array_split(np.arange(dims), max(1, -(-dims // block_dims)))]
        self.starts = offsets_of(np.array(sizes))
        limit, error = SCALE * math.sqrt(max(0.0, 2 - 2 * cosine)), 1.001 * math.sqrt(dims) + 1
        self.most = math.floor((limit + error) ** 2)  # beyond: not linked
        self.sure = math.floor(max(0.0, limit - error) ** 2) if limit > error else -1  # within: linked
        self.shares = [self.most * n / dims for n in sizes]

    def block(self, b: int) -> slice:
        return slice(int(self.starts[b]), int(self.starts[b + 1]))

    def radius(self, b: int) -> float:
        return math.sqrt(self.shares[b]) * (1 + 1e-9)

    def axes(self, b: int, rows: int, region_rows: int) -> int:
        """Grid axes for a label of so many rows: each one halves them, at least."""
        if rows <= region_rows:
            return 0
        per_axis = math.floor(SCALE / self.radius(b)) + 4
        n = self.block(b)
        return min(n.stop - n.start, math.ceil(math.log2(rows / region_rows)), int(62 / math.log2(per_axis)))


def cells(codes: np.ndarray, budget: Budget, b: int, axes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home) of every cell that a row lives in or visits; a visited cell comes later
    than the row's own, so two rows of different cells meet once."""
    n = len(codes)
    if not axes:
        return np.arange(n), np.zeros(n, np.int64), np.ones(n, bool)
    radius = budget.radius(b)
    x = codes[:, budget.block(b)][:, :axes] / (2 * radius)
    own = np.floor(x).astype(np.int64)
    step = np.where(x - own >= 0.5, 1, -1)  # the neighbour that half a cell's width reaches
    base = math.floor(SCALE / radius) + 4
    weight = base ** np.arange(axes - 1, -1, -1, dtype=np.int64)
    home = (own + base // 2) @ weight
    rows, found = [np.arange(n)], [home]
    for subset in range(1, 1 << axes):
        chosen = np.array([subset >> a & 1 for a in range(axes)])
        there = home + (step * chosen) @ weight
        at = np.flatnonzero(there > home)
        rows.append(at)
        found.append(there[at])
    return np.concatenate(rows), np.concatenate(found), np.concatenate([np.ones(n, bool), np.zeros(sum(map(len, rows[1:])), bool)])


def leaves(x: np.ndarray) -> list[np.ndarray]:
    """Rows in groups of neighbours: equal parts along up to three axes in turn."""
    axes = min(3, x.shape[1])
    parts = math.ceil((len(x) / LEAF_ROWS) ** (1 / axes))

    def cut(index, axis):
        if axis == axes or parts == 1 or len(index) <= LEAF_ROWS:
            return [index]
        order = index[np.argsort(x[index, axis], kind="stable")]
        return [leaf for p in np.array_split(order, parts) if len(p) for leaf in cut(p, axis + 1)]

    return cut(np.arange(len(x)), 0)


class Region:
    """Nodes of one region and what is found about them in block ``b``."""

    def __init__(self, codes: np.ndarray, size: np.ndarray, home: np.ndarray, side: np.ndarray, budget: Budget, b: int):
        self.codes, self.size, self.home, self.side, self.budget, self.b = codes, size.astype(np.float64), home, side, budget, b
        self.split = bool(side.any())  # two chunks: pairs within one are compared elsewhere
        self.links = np.zeros(len(codes), np.int64)
        self.parent = np.arange(len(codes))
        self.unsure: list[np.ndarray] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Components of the nodes, by hooking roots onto smaller ones."""
        while True:
            ra, rb = self.parent[a], self.parent[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up

    def take(self, i: np.ndarray, j: np.ndarray, total: np.ndarray) -> None:
        """Pairs of this block with their whole squared distances."""
        ok = (self.home[i] | self.home[j]) & (total <= self.budget.most)
        if self.split:
            ok &= self.side[i] != self.side[j]
        sure = ok & (total <= self.budget.sure)
        left = ok & ~sure
        if left.any():
            self.unsure.append(np.stack([i[left], j[left]], axis=1))
        i, j = i[sure], j[sure]
        if len(i):
            n = len(self.codes)
            self.links += np.bincount(i, self.size[j], n).astype(np.int64) + np.bincount(j, self.size[i], n).astype(np.int64)
            self.join(i, j)

    def verify_pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        for k in range(0, len(i), SLICE):
            p, q = i[k : k + SLICE], j[k : k + SLICE]
            square = (self.codes[p].astype(np.int64) - self.codes[q]) ** 2
            parts = np.add.reduceat(square, self.budget.starts[:-1], axis=1)
            first = parts[:, self.b] <= self.budget.shares[self.b]
            for e in range(self.b):
                first &= parts[:, e] > self.budget.shares[e]
            self.take(p[first], q[first], parts[first].sum(axis=1))

    def verify_tile(self, rows: np.ndarray, cols: np.ndarray, same: bool) -> None:
        """All pairs of two sets of rows; integers below 2**53 stay exact in matrix products."""
        total, first = np.zeros((len(rows), len(cols))), np.ones((len(rows), len(cols)), bool)
        for e in range(len(self.budget.shares)):
            x, y = (self.codes[r][:, self.budget.block(e)].astype(np.float64) for r in (rows, cols))
            part = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
            if e <= self.b:
                first &= part <= self.budget.shares[e] if e == self.b else part > self.budget.shares[e]
            total += part
        first &= total <= self.budget.most
        i, j = np.nonzero(np.triu(first, 1) if same else first)
        self.take(rows[i], cols[j], total[i, j])

    def run(self) -> None:
        x = self.codes[:, self.budget.block(self.b)].astype(np.float32)
        share = self.budget.shares[self.b]
        norm = (x.astype(np.float64) ** 2).sum(axis=1)
        slack = 1e-5 * float(norm.max(initial=0.0)) + 1  # single precision only picks candidates
        groups = leaves(x)
        low, high = np.stack([x[g].min(axis=0) for g in groups]), np.stack([x[g].max(axis=0) for g in groups])
        for a, rows in enumerate(groups):
            gap = np.maximum(0, np.maximum(low[a:] - high[a], low[a] - high[a:])).astype(np.float64)
            near = a + np.flatnonzero((gap * gap).sum(axis=1) <= share)
            strips = [(rows, True)]
            rest = np.concatenate([np.zeros(0, np.int64), *(groups[k] for k in near.tolist() if k != a)])
            strips += [(rest[k : k + TILE_ROWS], False) for k in range(0, len(rest), TILE_ROWS)]
            least = ((norm[rows] - share - slack) / 2).astype(np.float32)[:, None]
            for cols, same in strips:
                hit = x[rows] @ x[cols].T - least >= (norm[cols] / 2).astype(np.float32)
                if same:
                    hit = np.triu(hit, 1)
                n = int(np.count_nonzero(hit))
                if n > hit.size // 16:
                    self.verify_tile(rows, cols, same)
                elif n:
                    i, j = np.nonzero(hit)
                    self.verify_pairs(rows[i], cols[j])


def binary_rows(column) -> np.ndarray:
    """An Arrow column of binary values of one length, as a matrix of bytes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    width = int(offsets[1] - offsets[0]) if len(column) else 0
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if width else np.zeros(0, np.uint8)
    return data.reshape(len(column), width)


def binary_column(rows: np.ndarray) -> pa.Array:
    """The other way round; rows of a matrix of any type."""
    rows = np.ascontiguousarray(rows)
    raw = rows.view(np.uint8).reshape(len(rows), rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer((np.arange(len(raw) + 1) * raw.shape[1]).astype(np.int32)), pa.py_buffer(raw)])


REGION = "dim int, block int, cell long, home boolean, node binary, size long, codes binary"


def region_rows(vectors: DataFrame, cosine: float, block_dims: int, region_rows_: int) -> DataFrame:
    """Rows of all regions; ``vectors``: label, node, vector, label_rows (of large labels only).

    Equal vectors of a batch are combined, so copies hardly reach the shuffle.
    """
    schema = schema_with(vectors.select("label"), REGION)

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            node = binary_rows(batch.column("node"))
            column = batch.column("vector")
            lengths = np.diff(np.asarray(column.offsets))
            flat, starts = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), offsets_of(lengths)
            rows = np.asarray(batch.column("label_rows").fill_null(0))
            _, first, count = np.unique(node.view("V16").ravel(), return_index=True, return_counts=True)
            for dims in np.unique(lengths[first]).tolist():
                of_dim = lengths[first] == dims
                at, size = first[of_dim], count[of_dim]
                x = unit_rows(flat[starts[at][:, None] + np.arange(dims)]) @ rotation(dims)
                codes = np.rint(x * SCALE).astype(np.int16)
                budget = Budget(dims, cosine, block_dims)
                for b in range(len(budget.shares)):
                    for n in np.unique(rows[at]).tolist():
                        of_size = np.flatnonzero(rows[at] == n)
                        k, cell, home = cells(codes[of_size], budget, b, budget.axes(b, n, region_rows_))
                        k = of_size[k]
                        full = lambda v: pa.array(np.full(len(k), v, np.int32))
                        yield pa.RecordBatch.from_arrays([batch.column("label").take(pa.array(at[k])), full(dims), full(b), pa.array(cell), pa.array(home), binary_column(node[at[k]]), pa.array(size[k]), binary_column(codes[k])], schema.names)

    return vectors.mapInArrow(run, schema)


def in_chunk_pairs(dealt: DataFrame, region_rows_: int) -> DataFrame:
    """Rows of cells beyond ``region_rows_``, dealt to all pairs of the cell's chunks."""
    key = ["label", "dim", "block", "cell"]
    large = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > region_rows_)
    large = materialize(large.select(*key, F.ceil(F.col("rows") / region_rows_).cast("int").alias("chunks")), "subspace-cells")
    side = F.broadcast(large) if large.count() <= MOST_BROADCAST else large
    mine = F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))
    both = dealt.join(side, key, "left").withColumn("mine", mine).withColumn("other", other)
    return both.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other"), "side": F.col("mine") > F.col("other")}).drop("chunks", "mine", "other")


def compared(dealt: DataFrame, cosine: float, block_dims: int) -> DataFrame:
    """(a, b, links) of every region: a node, the root of its component there and the vectors
    linked with it; links is NULL where (a, b) is a pair that rounding leaves open."""
    schema = "a binary, b binary, links long"

    def run(table: pa.Table) -> pa.Table:
        node = binary_rows(table.column("node"))
        _, first, owner = np.unique(node.view("V16").ravel(), return_index=True, return_inverse=True)
        get = lambda c: table.column(c).to_numpy()
        size = np.bincount(owner, get("size"), len(first)).astype(np.int64)
        budget = Budget(int(get("dim")[0]), cosine, block_dims)
        region = Region(binary_rows(table.column("codes")).view(np.int16)[first], size, get("home")[first], get("side")[first], budget, int(get("block")[0]))
        region.run()
        key, at = node[first], np.flatnonzero(region.links)
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *region.unsure])
        links = pa.chunked_array([pa.array(region.links[at]), pa.nulls(len(pairs), pa.int64())])
        a, b = np.concatenate([key[at], key[pairs[:, 0]]]), np.concatenate([key[region.parent[at]], key[pairs[:, 1]]])
        return pa.table({"a": binary_column(a), "b": binary_column(b), "links": links.combine_chunks()})

    return dealt.groupBy("label", "dim", "block", "cell", "low", "high").applyInArrow(run, schema)


def cosines(pairs: DataFrame) -> DataFrame:
    """pairs (va, vb, ...) with their cosine in double precision."""

    def run(batches):
        for batch in batches:
            out = [float(unit_rows(np.array([a], np.float64))[0] @ unit_rows(np.array([b], np.float64))[0]) for a, b in zip(batch.column("va").to_pylist(), batch.column("vb").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "cosine"])

    return pairs.mapInArrow(run, "a binary, b binary, cosine double")


def node_key(*columns: str):
    """128 bits of hash of some columns."""
    parts = [F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(*columns), F.xxhash64(F.lit(7), *columns))]
    return F.unhex(F.concat(*parts))


def near_vectors(vectors: DataFrame, cosine: float = 0.98, block_dims: int = BLOCK_DIMS, region_rows_: int = REGION_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    number = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) <= 1.7976931348623157e308))
    valid = F.col("label").isNotNull() & F.coalesce(number & F.exists("embedding", lambda c: c != 0), F.lit(False))
    rows = vectors.select("vec_id", "embedding", "label").withColumn("node", F.when(valid, node_key("label", "embedding")))
    members = materialize(rows.select("vec_id", "node"), "subspace-members")

    usable = rows.where("node is not null").select("label", "node", F.col("embedding").alias("vector"))
    large = materialize(vectors.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("label_rows")).where(F.col("label_rows") > region_rows_), "subspace-labels")
    n_large = large.count()
    if n_large:
        with_rows = usable.join(F.broadcast(large) if n_large <= MOST_BROADCAST else large, "label", "left")
        dealt = in_chunk_pairs(region_rows(with_rows, cosine, block_dims, region_rows_), region_rows_)
    else:
        with_rows = usable.withColumn("label_rows", F.lit(None).cast("long"))
        dealt = region_rows(with_rows, cosine, block_dims, region_rows_).withColumns({"low": F.lit(0), "high": F.lit(0), "side": F.lit(False)})
    found = materialize(compared(dealt, cosine, block_dims), "subspace-found")

    sums = found.where("links is not null").select(F.col("a").alias("node"), "links")
    edges = found.where("links is not null and a <> b").select("a", "b")
    classes = members.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least"))
    unsure = found.where("links is null").select("a", "b")
    if not unsure.isEmpty():
        ends = unsure.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        looked_up = usable.join(ends, "node", "left_semi").groupBy("node").agg(F.first("vector").alias("v"))
        looked_up = materialize(looked_up, "subspace-open")
        of = lambda n: looked_up.select(F.col("node").alias(n), F.col("v").alias(f"v{n}"))
        linked = materialize(cosines(unsure.join(of("a"), "a").join(of("b"), "b")).where(F.col("cosine") >= cosine).select("a", "b"), "subspace-decided")
        edges = edges.unionByName(linked)
        sizes = classes.select("node", "size")
        for x, y in (("a", "b"), ("b", "a")):
            sums = sums.unionByName(linked.join(sizes.withColumnRenamed("node", y), y).select(F.col(x).alias("node"), F.col("size").alias("links")))
    sums = sums.groupBy("node").agg(F.sum("links").alias("links"))

    parts = components(edges).select(F.col("key").alias("node"), "component")
    least = parts.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    named = parts.join(least, "component").select("node", "component_id")
    # one row for each distinct vector; a vector of very many copies is split by the skew join
    facts = classes.join(sums, "node", "left").join(named, "node", "left").select("node", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    out = members.join(facts, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
