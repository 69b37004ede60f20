"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors are rotated by a fixed random rotation and split into blocks of few dimensions.
Cosine s means squared distance 2 - 2s, which is the sum over the blocks; so at least one
block's squared distance is within its share of it, in proportion to its dimensions. In
each block a range join finds these pairs: a vector lives in one cell of a grid and visits
every cell that its range touches. Where a resident and a visitor meet, the pair is
verified by its cosine in double precision, and counted in the first block whose share it
keeps, hence once, whatever else they share.

Links are counted where they are found and are never written as pairs: of each meeting a
spanning forest is kept, with one row per vector at most. Residents and visitors of a cell
that has many are both dealt out, and each part of the one meets each part of the other.

Equal vectors of one label are one class, told apart by 128 bits of hash. Only one of a
class lives and visits, and its meetings count as many links as the others have members.

Only vectors with equal, not null labels are compared. Vectors that are null or zero, or
that hold null or non-finite components, and those whose label is null, link with nothing,
like any of another length than the rest: lengths are joined separately. Repeated rows are
vectors of their own and link with each other. A null id keeps its row; its component is
the least id that is not null. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.components import component_labels
from creaseline.llm.words import mixed_bits
from creaseline.sources.workspace import settled

COSINE = 0.98
BLOCKS = 8
CELL_RANGES = 5.0  # a cell's width in ranges
AT_ONCE = 2000  # residents or visitors of a cell in one task
ROWS_PER_BUCKET = 4000
VISITS = 90  # of a vector, about
PAIRS_AT_ONCE = 500_000
SLACK = 1e-9


def rotation(dimensions: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dimensions).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def block_edges(dimensions: int, blocks: int = BLOCKS) -> list[int]:
    blocks = min(blocks, dimensions)
    return [dimensions * k // blocks for k in range(blocks + 1)]


def budgets(dimensions: int, cosine: float, blocks: int = BLOCKS) -> np.ndarray:
    edges = np.array(block_edges(dimensions, blocks))
    return (2 - 2 * cosine) * (1 + SLACK) * np.diff(edges) / dimensions + 1e-12


def cells_in_range(x: np.ndarray, reach: float, width: float) -> tuple[np.ndarray, np.ndarray]:
    """The grid cells within ``reach`` of each point: the point's place, and the cell."""
    home = np.floor(x / width)
    owner, cells, spent = np.arange(len(x)), home.copy(), np.zeros(len(x))
    for k in range(x.shape[1]):
        own, at = home[owner, k] * width, x[owner, k]
        made = [(owner, cells, spent)]
        for step in range(1, int(reach / width) + 2):
            for side in (-1, 1):
                gap = at - own + (step - 1) * width if side < 0 else own + step * width - at
                cost = spent + gap * gap
                near = cost <= reach * reach
                moved = cells[near]
                moved[:, k] += side * step
                made.append((owner[near], moved, cost[near]))
        owner, cells, spent = (np.concatenate(part) for part in zip(*made))
    return owner, cells.astype(np.int64)


def cell_keys(cells: np.ndarray, block: int, labels: np.ndarray, dimensions: int) -> np.ndarray:
    """One number for label, block and cell; a chance clash only adds a meeting."""
    key = mixed_bits(mixed_bits(labels.astype(np.int64).view(np.uint64)) + np.uint64(block * 4099 + dimensions))
    for k in range(cells.shape[1]):
        key = mixed_bits(key + cells[:, k].view(np.uint64))
    return key.view(np.int64)


def units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; rows that are zero or not finite become NaN."""
    x = vectors.astype(float)
    with np.errstate(all="ignore"):
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.where(np.isfinite(x).all(axis=1, keepdims=True), x, np.nan)


def in_blocks(x: np.ndarray, blocks: int) -> np.ndarray:
    """Rotated vectors as (row, block, coordinate), short blocks padded with zeros."""
    edges = block_edges(x.shape[1], blocks)
    y = x @ rotation(x.shape[1])
    out = np.zeros((len(x), len(edges) - 1, max(np.diff(edges))))
    for b in range(len(edges) - 1):
        out[:, b, : edges[b + 1] - edges[b]] = y[:, edges[b] : edges[b + 1]]
    return out


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and vectors (as a matrix) of each length; lists with nulls are left out."""
    offsets = column.offsets.to_numpy()
    lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
    values = column.values.to_numpy(zero_copy_only=False).astype(column.type.value_type.to_pandas_dtype())
    holes = np.cumsum(np.concatenate([[0], column.values.is_null().to_numpy(zero_copy_only=False)]))
    usable = holes[offsets[1:]] == holes[offsets[:-1]]
    for d in np.unique(lengths[(lengths > 0) & usable]):
        at = np.flatnonzero((lengths == d) & usable)
        yield at, values[offsets[at][:, None] + np.arange(d)]


def usable(label: str, vector: str) -> Column:
    """Whether a vector can link: with a label, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def visits(cosine: float, blocks: int, carry: bool):
    """row, cell, block, resident; a resident row and its visits, for each block.

    On request with the vector and how many there are of it.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                yield from of_slice(batch.slice(start, 512))

    def of_slice(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        labelled = batch.filter(batch.column(1).is_valid())
        ids, labels = labelled.column(0).to_numpy(), labelled.column(1).to_numpy()
        vectors = pa.concat_arrays([labelled.column(2)])
        for at, matrix in by_length(vectors):
            x = units(matrix)
            at, matrix, x = at[~np.isnan(x[:, 0])], matrix[~np.isnan(x[:, 0])], x[~np.isnan(x[:, 0])]
            d, y, limits = matrix.shape[1], in_blocks(x, blocks), budgets(matrix.shape[1], cosine, blocks)
            for b, limit in enumerate(limits):
                reach = float(np.sqrt(limit)) * (1 + SLACK)
                owner, cells = cells_in_range(y[:, b], reach, reach * CELL_RANGES)
                keys = cell_keys(cells, b, labels[at][owner], d)
                own = np.arange(len(owner)) < len(at)  # each point's own cell stands first
                _, distinct = np.unique(np.stack([owner, keys]), axis=1, return_index=True)
                owner, keys = np.concatenate([owner[own], owner[distinct]]), np.concatenate([keys[own], keys[distinct]])
                resident = np.arange(len(owner)) < len(at)
                columns = [pa.array(ids[at][owner]), pa.array(keys), pa.array(np.full(len(owner), b, np.int32)), pa.array(resident)]
                names = ["row", "cell", "block", "resident"]
                if carry:
                    ends = pa.array(np.arange(len(owner) + 1, dtype=np.int32) * d)
                    columns.append(pa.ListArray.from_arrays(ends, pa.array(matrix[owner].ravel())))
                    columns.append(labelled.column(3).take(pa.array(at[owner])))
                    names += ["vector", "copies"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def forest(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """Each node's smallest node that it is connected with."""
    root = np.arange(size)
    while True:
        least = root.copy()
        np.minimum.at(least, left, root[right])
        np.minimum.at(least, right, root[left])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def candidates(cell: np.ndarray, resident: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of residents and of the visitors of their cell, in pieces of bounded size."""
    hosts, guests = np.flatnonzero(resident), np.flatnonzero(~resident)
    guests = guests[np.argsort(cell[guests], kind="stable")]
    low = np.searchsorted(cell[guests], cell[hosts], "left")
    number = np.searchsorted(cell[guests], cell[hosts], "right") - low
    piece = np.cumsum(number) // PAIRS_AT_ONCE
    for k in np.unique(piece):
        mine = piece == k
        n = number[mine]
        left = np.repeat(hosts[mine], n)
        shift = np.repeat(low[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        yield left, guests[shift + np.arange(len(left))]


def meeting(cosine: float, blocks: int):
    """Links per resident, and a spanning forest, of the cells of one group."""

    def rows(table: pa.Table) -> pa.Table:
        whole = table.combine_chunks()
        if not whole.num_rows:
            return pa.table({"row": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})
        ids, cell, block = (whole.column(c).to_numpy() for c in ("row", "cell", "block"))
        resident, copies = whole.column("resident").to_numpy(), whole.column("copies").to_numpy()
        names, node = np.unique(ids, return_inverse=True)
        count, trees = np.zeros(len(names), np.int64), []
        vectors = pa.concat_arrays(whole.column("vector").chunks)
        for at, matrix in by_length(vectors):
            x = units(matrix)
            y, limits = in_blocks(x, blocks), budgets(x.shape[1], cosine, blocks)
            b, node_at, times = block[at], node[at], copies[at]
            mine = y[np.arange(len(at)), b]
            for left, right in candidates(cell[at], resident[at]):
                near = ((mine[left] - mine[right]) ** 2).sum(axis=1) <= limits[b[left]]
                near &= (b[left] == b[right]) & (node_at[left] != node_at[right])
                left, right = left[near], right[near]
                link = (x[left] * x[right]).sum(axis=1) >= cosine
                left, right = left[link], right[link]
                square = ((y[left] - y[right]) ** 2).sum(axis=2) <= limits
                first = square.argmax(axis=1) == b[left]  # counted in the first block that is near
                left, right = left[first], right[first]
                np.add.at(count, node_at[left], times[right])
                left, right = node_at[left], node_at[right]
                root = forest(left, right, len(names))
                child = np.flatnonzero(root != np.arange(len(names)))
                trees.append((child, root[child]))
        left, right = (np.concatenate(t) for t in zip(*trees)) if trees else (np.empty(0, int),) * 2
        root = forest(left, right, len(names))
        linked, child = np.flatnonzero(count), np.flatnonzero(root != np.arange(len(names)))
        return pa.table(
            {
                "row": pa.array(np.concatenate([names[linked], names[child]])),
                "links": pa.array(np.concatenate([count[linked], np.zeros(len(child), np.int64)])),
                "other": pa.concat_arrays([pa.nulls(len(linked), pa.int64()), pa.array(names[root[child]])]),
            }
        )

    return rows


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    rows = embeddings.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    sign = lambda k: F.when(usable("label", "embedding"), F.xxhash64(F.lit(k), "label", "embedding"))
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "sign": sign(1), "sign2": sign(2)})
    numbered = settled(rows, "vectors")
    able = numbered.where("sign is not null")
    classes = able.groupBy("sign", "sign2").agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    classes = settled(classes, "vector-classes")
    vectors = able.select("row", "label", "embedding").join(classes.select("row", "copies"), "row")
    vectors = settled(vectors.select("row", "label", "embedding", "copies"), "vector-representatives")
    kind = embeddings.schema["embedding"].dataType.simpleString()
    light = vectors.mapInArrow(visits(cosine, blocks, False), "row long, cell long, block int, resident boolean")
    cells = light.groupBy("cell").agg(F.count_if("resident").alias("hosts"), F.count_if(~F.col("resident")).alias("guests"))
    parts = lambda n: F.ceil(F.col(n) / AT_ONCE).cast("int").alias(n)
    hot = settled(cells.where(F.greatest("hosts", "guests") > AT_ONCE).select("cell", parts("hosts"), parts("guests")), "vector-cells")
    buckets = classes.count() * VISITS // ROWS_PER_BUCKET + 1

    rows = vectors.mapInArrow(visits(cosine, blocks, True), f"row long, cell long, block int, resident boolean, vector {kind}, copies long")
    rows = rows.join(hot, "cell", "left").withColumns({"hosts": F.coalesce("hosts", F.lit(1)), "guests": F.coalesce("guests", F.lit(1))})
    one = lambda n: F.array(F.pmod(F.xxhash64("row"), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    rows = rows.withColumn("host_part", F.explode(F.when(F.col("resident"), one("hosts")).otherwise(every("hosts"))))
    rows = rows.withColumn("guest_part", F.explode(F.when(F.col("resident"), every("guests")).otherwise(one("guests"))))
    rows = rows.withColumn("bucket", F.pmod("cell", F.lit(buckets))).select("row", "cell", "block", "resident", "vector", "copies", "bucket", "host_part", "guest_part")
    met = rows.groupBy("bucket", "host_part", "guest_part").applyInArrow(meeting(cosine, blocks), "row long, links long, other long")
    met = settled(met, "vector-links")

    counts = met.groupBy("row").agg(F.sum("links").alias("n_links"))
    edges = met.where("other is not null")
    labels = component_labels(edges, "row", "other").toDF("row", "root")
    table = classes.join(counts, "row", "left").join(labels, "row", "left")
    table = settled(table.withColumn("root", F.coalesce("root", "row")), "vector-components")
    least = table.groupBy("root").agg(F.min("first").alias("component_id"))
    links = (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links")
    table = table.join(least, "root").select("sign", "sign2", links, "component_id")
    alone = numbered.where("sign is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = able.select("vec_id", "sign", "sign2").join(table, ["sign", "sign2"]).select("vec_id", "n_links", "component_id").union(alone)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
