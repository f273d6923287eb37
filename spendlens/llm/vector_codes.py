"""Vector codes by product quantisation, with codebooks learnt by dual-tree Lloyd rounds.

Components become integers (``floor(256 * x)``) and a vector is cut into equal parts, each
coded by the nearest of the entries of its part position. Rows are put into blocks of bounded
size where they lie, without a shuffle, and each block is stored with a k-d tree over the points
of each part, so a tree is built once and used in every round. A round walks the trees of a
block and a tree over the entries together, level by level:

* for a pair of nodes, the boxes give the least and the greatest squared distance between
  their members; an entry node that is farther at best than another is at worst is pruned;
* a point node with one entry left is assigned whole, by its cached count and sum;
* points in leaves with several entries left are compared with those entries in integers,
  ties to the lower index.

Boxes, sums and distances are integers, so pruning never decides a tie. Tasks return counts
and sums per part and entry; Spark adds them up, and only the codebooks (parts x entries x
part length integers, whatever the number of vectors) reach the driver.

Defined cases: rows whose vector is null or holds a null, a NaN or an infinity are dropped, also
an empty vector, one that can't be cut into equal parts, and one of another length than that of
the least id; ids that tie start codebooks in the order of their vectors, null ids come last;
fewer vectors than entries give shorter codebooks; repeated rows count as often as they occur;
null labels are one label; an empty table gives an empty result; a component of 65,536 or more
raises ValueError (distances would leave 64 bits); further columns are ignored.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Points of a tree's leaf, rows of a block (fewer for long vectors), blocks handed to Python at once.
LEAF, BLOCK_ROWS, BLOCKS_AT_ONCE = 16, 4096, 8
#: Bytes of a stored row group: what a reader holds at once.
ROW_GROUP = 16 << 20
LIMIT = 1 << 24


@contextlib.contextmanager
def _batches_of(spark, rows: int):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# ------------------------------------------------------------------------------- trees
def _depth(n: int, leaf: int) -> int:
    return max(0, (n // leaf).bit_length() - 1)


def _bounds(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level start, and the end: halves of halves, so levels nest."""
    return (np.arange((1 << level) + 1) * n) >> level


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """For points (parts, n, d): the order that makes every level's nodes consecutive, (parts, n).

    Every node is halved at the median of its widest dimension; all nodes of a level in all parts at once.
    """
    parts, n, _ = points.shape
    order = np.broadcast_to(np.arange(n), (parts, n))
    for level in range(_depth(n, leaf)):
        bounds = _bounds(n, level)
        at = np.take_along_axis(points, order[:, :, None], 1)
        starts = bounds[:-1]
        wide = (np.maximum.reduceat(at, starts, 1) - np.minimum.reduceat(at, starts, 1)).argmax(2)
        node = np.repeat(np.arange(len(starts)), np.diff(bounds))
        value = np.take_along_axis(at, wide[:, node, None], 2)[:, :, 0]
        rank = np.argsort(node * (4 * LIMIT) + value, axis=1, kind="stable")
        order = np.take_along_axis(order, rank, 1)
    return order


class Tree:
    """Boxes and sums of all nodes of points that lie in tree order, by level."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, n = points, points.shape[1]
        depth = _depth(n, leaf)
        self.bounds = [_bounds(n, level) for level in range(depth + 1)]
        starts = self.bounds[-1][:-1]
        self.lo, self.hi, self.sums = ([f.reduceat(points, starts, 1)] for f in (np.minimum, np.maximum, np.add))
        for _ in range(depth):
            for levels, f in ((self.lo, np.minimum), (self.hi, np.maximum), (self.sums, np.add)):
                levels.insert(0, f(levels[0][:, ::2], levels[0][:, 1::2]))


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that start at ``starts`` and are ``lengths`` long, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class Entries:
    """A tree over the entries (parts, k, d) of every part, down to single entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.index = tree_order(entries, 1)  # the entry at each place of the tree's order
        tree = Tree(np.take_along_axis(entries, self.index[:, :, None], 1), 1)
        self.bounds = [*tree.bounds, np.arange(entries.shape[1] + 1)]
        self.lo, self.hi = [*tree.lo, tree.points], [*tree.hi, tree.points]
        self.single = len(self.bounds) - 1  # the level of single entries

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and number of children of nodes."""
        if level < self.single - 1:
            return 2 * node, np.full(len(node), 2)
        places = self.bounds[level]
        return places[node], places[node + 1] - places[node]


def assigned(tree: Tree, entries: Entries, whole) -> np.ndarray:
    """The nearest entry of every point, (parts, n), in tree order.

    ``whole(part, entry, level, node)`` gets the nodes that were assigned whole, ``whole(part, entry, None, place)``
    the points that were compared one by one.
    """
    parts, n, _ = tree.points.shape
    out = np.zeros((parts, n), np.int64)
    part, node, enode = np.arange(parts), np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    level = elevel = 0
    last = len(tree.bounds) - 1
    while True:
        # pairs lie by (part, node); an entry node stays if it may hold the nearest entry of some point of the node
        plo, phi, elo, ehi = tree.lo[level][part, node], tree.hi[level][part, node], entries.lo[elevel][part, enode], entries.hi[elevel][part, enode]
        near = (np.maximum(0, np.maximum(plo - ehi, elo - phi)) ** 2).sum(1)
        far = (np.maximum(phi - elo, ehi - plo) ** 2).sum(1)
        new = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(node) != 0)])
        stays = near <= np.repeat(np.minimum.reduceat(far, new), np.diff(np.r_[new, len(part)]))
        part, node, enode = part[stays], node[stays], enode[stays]
        new = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(node) != 0)])
        size = np.diff(np.r_[new, len(part)])
        if elevel == entries.single:
            alone = np.repeat(size == 1, size)
            if alone.any():
                p, k = part[alone], node[alone]
                e = entries.index[p, enode[alone]]
                start = tree.bounds[level][k]
                length = tree.bounds[level][k + 1] - start
                out[np.repeat(p, length), _spans(start, length)] = np.repeat(e, length)
                whole(p, e, level, k)
                part, node, enode = part[~alone], node[~alone], enode[~alone]
            if level == last or not len(part):
                break
        if elevel < entries.single:
            first, many = entries.children(elevel, enode)
            part, node, enode, elevel = np.repeat(part, many), np.repeat(node, many), _spans(first, many), elevel + 1
        if level < last:
            # both halves of a node keep its entry nodes: the pairs of a group twice, one half after the other
            new = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(node) != 0)])
            size = np.diff(np.r_[new, len(part)])
            again = _spans(np.repeat(new, 2), np.repeat(size, 2))
            half = np.repeat(np.tile([0, 1], len(new)), np.repeat(size, 2))
            part, node, enode, level = part[again], 2 * node[again] + half, enode[again], level + 1
    if len(part):
        entry = entries.index[part, enode]
        by = np.lexsort((entry, node, part))
        part, node, entry = part[by], node[by], entry[by]
        new = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(node) != 0)])
        size = np.diff(np.r_[new, len(part)])
        start = tree.bounds[last][node[new]]
        length = tree.bounds[last][node[new] + 1] - start
        group, p, place = np.repeat(np.arange(len(new)), length), np.repeat(part[new], length), _spans(start, length)
        points = tree.points[p, place]
        least, best = np.full(len(p), np.iinfo(np.int64).max), np.zeros(len(p), np.int64)
        for j in range(int(size.max())):
            some = np.flatnonzero(size[group] > j)
            e = entry[new[group[some]] + j]
            distance = ((points[some] - entries.entries[p[some], e]) ** 2).sum(1)
            less = distance < least[some]  # entries come in ascending order: a tie stays with the lower
            least[some[less]], best[some[less]] = distance[less], e[less]
        out[p, place] = best
        whole(p, best, None, place)
    return out


# ------------------------------------------------------------------------------- tasks
def _blocks(parts: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, block_rows - rows)
                held.append(batch.slice(0, take))
                rows, batch = rows + take, batch.slice(take)
                if rows == block_rows:
                    yield block(pa.Table.from_batches(held))
                    held, rows = [], 0
        if rows:
            yield block(pa.Table.from_batches(held))

    def block(table: pa.Table) -> pa.RecordBatch:
        ids, labels, vectors = (table.column(c).combine_chunks() for c in ("vec_id", "label", "v"))
        n = len(ids)
        numbers = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False)).reshape(n, parts, -1)
        if (np.abs(numbers) >= LIMIT).any():
            raise ValueError(f"vector components reach {LIMIT // SCALE}")
        points = numbers.astype(np.int64).transpose(1, 0, 2)
        order = tree_order(points, LEAF)
        points = np.take_along_axis(points, order[:, :, None], 1)
        one = lambda a: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), a)
        return pa.RecordBatch.from_arrays(
            [one(ids), one(labels), pa.array([points.astype(np.int32).tobytes()]), pa.array([order.astype(np.int32).tobytes()])],
            names=["ids", "labels", "points", "place"])

    return run


def _loaded(batch: pa.RecordBatch, parts: int):
    """Each stored block of a batch: ids, labels, the points' tree, and the row of each point."""
    for i in range(batch.num_rows):
        ids, labels = (batch.column(c)[i].values for c in ("ids", "labels"))
        points, place = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int32).astype(np.int64) for c in ("points", "place"))
        n = len(ids)
        yield ids, labels, Tree(points.reshape(parts, n, -1), LEAF), place.reshape(parts, n)


def _totals(entries: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, d = entries.shape
        book = Entries(entries)
        counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, d), np.int64)
        for batch in batches:
            for _, _, tree, _ in _loaded(batch, parts):
                def whole(part, entry, level, at):
                    one = level is None
                    np.add.at(counts, (part, entry), 1 if one else np.diff(tree.bounds[level])[at])
                    np.add.at(sums, (part, entry), tree.points[part, at] if one else tree.sums[level][part, at])

                assigned(tree, book, whole)
        part, entry, dim = np.indices(sums.shape).reshape(3, -1)
        yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()),
                                          "dim": pa.array(dim, pa.int32()), "n": np.repeat(counts.ravel(), d), "total": sums.ravel()})

    return run


def _codes(entries: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(entries)
        book = Entries(entries)
        for batch in batches:
            for ids, labels, tree, place in _loaded(batch, parts):
                entry = assigned(tree, book, lambda *_: None)
                codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for p in range(parts):
                    codes[place[p], p] = entry[p]
                    error[place[p]] += ((tree.points[p] - entries[p, entry[p]]) ** 2).sum(1)
                text = codes.tobytes().hex()
                width = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([text[i:i + width] for i in range(0, len(text), width)]), pa.array(error)],
                    names=["vec_id", "label", "code", "error"])

    return run


# ----------------------------------------------------------------------------- operator
def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """vec_id, label and v (DOUBLE components) of the rows that can be coded, of whatever length."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("v").isNotNull() & F.forall("v", finite) & (F.size("v") > 0) & (F.size("v") % parts == 0))


def _firsts(rows: DataFrame, k: int) -> list[list[float]]:
    return [r.v for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(k).select("v").collect()]


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable vector, and the codebooks (parts, entries, part length)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits per part")
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col, parts)
    firsts = _firsts(rows, entries)
    if len({len(v) for v in firsts}) > 1:
        firsts = _firsts(rows.where(F.size("v") == len(firsts[0])), entries)
    types = dict(rows.dtypes)
    coded = f"vec_id {types['vec_id']}, label {types['label']}, code string, error bigint"
    if not firsts:
        return spark.createDataFrame([], coded), np.zeros((parts, 0, 0), np.int64)
    dims = len(firsts[0])
    book = np.floor(SCALE * np.array(firsts)).reshape(len(firsts), parts, -1)
    if (np.abs(book) >= LIMIT).any():
        raise ValueError(f"vector components reach {LIMIT // SCALE}")
    book = book.astype(np.int64).transpose(1, 0, 2)
    block_rows = min(BLOCK_ROWS, max(LEAF, (1 << 20) // (4 * dims)))
    blocks = stored(
        rows.where(F.size("v") == dims).mapInArrow(
            _blocks(parts, block_rows),
            f"ids array<{types['vec_id']}>, labels array<{types['label']}>, points binary, place binary"),
        "blocks", **{"parquet.block.size": ROW_GROUP})
    with _batches_of(spark, BLOCKS_AT_ONCE):
        for _ in range(rounds):
            totals = (blocks.mapInArrow(_totals(book), "part int, entry int, dim int, n bigint, total bigint")
                      .groupBy("part", "entry", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
            book = book.copy()
            for part, entry, dim, n, total in totals.collect():  # parts x entries x part length rows
                if n:
                    book[part, entry, dim] = total // n
        return stored(blocks.mapInArrow(_codes(book), coded), "codes"), book


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows of a label added up, nulls together.

    Sums are taken map-side and joined back as one row per label, so no label's rows meet in one task.
    """
    sums = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_of"))).drop("_of")
