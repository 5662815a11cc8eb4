"""N-gram Jaccard join (operator 10): group counts, a count-vector R-tree, verification.

A document's set holds its distinct word shingles as 64-bit hashes. Documents of
equal sets are one node. Two nodes link when ``100 * |A & B| >= percent * |A | B|``.

Blocks. Linked sets differ in at most ``K`` shingles, where ``K`` follows from the
smaller size and the threshold. Sizes are cut into bands so that linked nodes lie
in one band or two adjacent ones, and per band the shingle hashes are split into
more than ``K`` groups: by pigeonhole some group is identical in both sets. A node
therefore joins the blocks named by the content of each of its groups; blocks of
one node, almost all of them, end in one window count. A common passage fills some
groups of every set that holds it, and those blocks grow with the corpus. So sets are
split into ``extra`` groups more than needed, and each node leaves its ``extra`` fullest
blocks: linked sets still meet in the least full one that they share.

Linking. Nodes whose blocks have the same smallest node form a family. First every
family is compared with that smallest node, which joins a group of near copies in
as many pairs as it has nodes: the summed minima of the two count vectors (shingles per
hash group) bound the overlap, and pairs that may reach the threshold are verified
on the sets. In families that still hold several components, the nodes' count
vectors are points in an R-tree: the sum over coordinates of the smaller of a
point's count and a box's largest count bounds the overlap from above, and boxes and
points that cannot reach the threshold are cut. Surviving pairs of different
components are verified in that task, and only links that join two components leave it:
fewer than it holds nodes. Pairs inside a component are never listed.

A large family is split into chunks that meet pairwise, so no task holds more than
two chunks of it. 64-bit hashes stand for shingles and sets; a wrong link needs a
collision between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from . import _text
from ._graph import components
from ._text import U64

WORDS = 4
PERCENT = 85
LEAST_GROUPS, MOST_GROUPS = 64, 4096  # coordinates of a count vector: about half the set's size
NEAR_PERCENT = 60   # bound from which two families are searched as one
EXTRA = 8           # a set has a group to spare for so many shingles that may differ
FULL_BLOCK = 4      # nodes up to which no node leaves a block
FULL = 255          # a count of FULL stands for that many or more
CHUNK_NODES = 2048  # nodes of a family that one side of a task holds
CHUNK_SHINGLES = 1 << 21  # shingles of them (16 MB)
LEAF = 16           # entries of an R-tree node


def set_rows(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, shingle)`` of every distinct shingle, by row, then shingle."""
    rows, starts, ends = _text.words(data, offsets, _text.space_table())
    if not len(rows):
        return rows, np.zeros(0, U64)
    hashes = _text.range_hash(_text.prefix_hash(data, fold=True), starts, ends)
    rows, found = _text.shingles(hashes, rows, words)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    new = np.r_[True, (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])]
    return rows[new], found[new]


def _group_sums(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of 64-bit values per index, modulo 2**64 (exact for 2**21 values each)."""
    low = np.bincount(index, (values & U64(0xFFFFFFFF)).astype(float), size).astype(U64)
    high = np.bincount(index, (values >> U64(32)).astype(float), size).astype(U64)
    return low + (high << U64(32))


def band_edges(largest: int, percent: int) -> np.ndarray:
    """First size of each band up to one above ``largest``: linked sizes are at most
    one band apart."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, np.int64)


def group_keys(rows: np.ndarray, found: np.ndarray, n: int, percent: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, key)`` of every block that a set belongs to, and how many it may leave.

    A set of band ``i`` takes part in space ``i`` (with its own band and the next)
    and in space ``i - 1``. A space splits hashes into ``K + 1 + extra`` groups,
    ``K`` being the largest difference of linked sets whose smaller one is in band
    ``i``; at least ``1 + extra`` groups are identical. Empty groups would be
    shared by chance, so they are named only by sets with more than ``extra`` of
    them: if all identical groups are empty, both sets have that many.

    A set with fewer empty groups may leave as many blocks as it lacks to ``extra``, the
    fullest of its space first. Order the groups of a space, filled ones by how full
    their blocks are and empty ones as the fullest: neither of two linked sets leaves the
    least full group that they share, each of them sharing ``extra`` fuller ones.
    ``spare[row, s]`` is that number in the space whose number is ``s`` modulo 2, which
    is also the last bit of the space's keys.
    """
    size = np.bincount(rows, minlength=n)
    edges = band_edges(int(size.max(initial=1)), percent)
    band = np.searchsorted(edges, size, "right") - 1
    out_rows, out_keys = [], []
    spare = np.zeros((n, 2), np.int32)
    spread = _text.mix(found ^ U64(0xA5A5A5A5A5A5A5A5))
    for back in (0, 1):
        space = band - back
        takes = (size > 0) & (space >= 0)
        upper = edges[np.minimum(np.maximum(space, 0) + 1, len(edges) - 1)] - 1
        differ = (100 - percent) * upper // percent
        extra = np.where(differ > 0, 2 + differ // EXTRA, 0)
        groups = np.where(takes, differ + 1 + extra, 0)
        base = np.r_[0, np.cumsum(groups)]
        total = int(base[-1])
        mine = takes[rows]
        of, member = rows[mine], found[mine]
        index = base[of] + ((spread[mine] >> U64(33)) % groups[of].astype(U64)).astype(np.int64)
        content = _group_sums(index, _text.mix(member), total)
        filled = np.bincount(index, minlength=total) > 0
        owner = np.repeat(np.arange(n), groups)
        number = np.arange(total) - base[owner]
        empties = np.bincount(owner[~filled], minlength=n)
        named = filled | (empties > extra)[owner]
        salt = (space[owner].astype(U64) << U64(32)) + number.astype(U64) + U64(1)
        key = _text.mix(content + _text.mix(salt)) & ~U64(1) | (space[owner] & 1).astype(U64)
        out_rows.append(owner[named])
        out_keys.append(key[named])
        spare[takes, space[takes] & 1] = np.where(empties > extra, 0, extra - empties)[takes]
    return np.concatenate(out_rows), np.concatenate(out_keys), spare


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)),
                                    pa.array(values, kind))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``(__id, text_hash, n_shingles, node, spare, keys)`` of every whole text; ``node`` names
    its set, ``keys`` its blocks, of which it may leave ``spare`` (see ``group_keys``)."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low, high in _text.chunks(part.column(1)):
                n = high - low
                texts = part.column(1).slice(low, n)
                rows, found = set_rows(*_text.column_bytes(texts), words)
                size = np.bincount(rows, minlength=n)
                node = _text.mix(_group_sums(rows, _text.mix(found), n) + size.astype(U64))
                owner, keys, spare = group_keys(rows, found, n, percent)
                order = np.argsort(owner, kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(low, n), part.column(2).slice(low, n), pa.array(size, pa.int64()),
                     pa.array(_text.signed(node)),
                     _lists(spare.ravel(), np.full(n, 2), pa.int32()),
                     _lists(_text.signed(keys[order]), np.bincount(owner, minlength=n), pa.int64())],
                    names=["__id", "text_hash", "n_shingles", "node", "spare", "keys"])

    rows = docs.select(F.col(f"`{id_col}`").alias("__id"),
                       F.col(f"`{text_col}`").cast("string").alias("__text"), text_hash(text_col).alias("__hash"))
    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"__id {kind}, text_hash bigint, n_shingles bigint, node bigint, "
                                    "spare array<int>, keys array<bigint>")


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{text_col}`").cast("string"))


def count_vector(found: np.ndarray) -> np.ndarray:
    """Shingles per hash group. The number of groups is a power of two that grows with
    the set, so that differences seldom fall into one group and hide each other."""
    groups = min(MOST_GROUPS, max(LEAST_GROUPS, 1 << (max(len(found), 2) // 2).bit_length()))
    counts = np.bincount((found & U64(groups - 1)).astype(np.int64), minlength=groups)
    return np.minimum(counts, FULL).astype(np.uint8)


def folded(vectors: list[bytes]) -> np.ndarray:
    """Count vectors as rows of one width, the smallest of theirs: wider ones are added
    up group by group."""
    width = min(map(len, vectors))
    out = np.empty((len(vectors), width), np.uint8)
    for i, v in enumerate(vectors):
        wide = np.frombuffer(v, np.uint8)
        out[i] = wide if len(wide) == width else np.minimum(
            wide.reshape(-1, width).sum(0, dtype=np.int64), FULL)
    return out


def sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, words: int,
         scratch) -> DataFrame:
    """``(node, size, counts, shingles)`` of the given nodes (``node, __id``), once each.

    Only documents with an id of a wanted node are read; ``counts`` is the count
    vector, ``shingles`` the sorted set, both as bytes.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(0)
            for low, high in _text.chunks(texts):
                n = high - low
                rows, found = set_rows(*_text.column_bytes(texts.slice(low, n)), words)
                size = np.bincount(rows, minlength=n)
                node = _text.mix(_group_sums(rows, _text.mix(found), n) + size.astype(U64))
                cut = np.r_[0, np.cumsum(size)]
                counts = [count_vector(found[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_text.signed(node)), pa.array(size, pa.int64()),
                     pa.array([c.tobytes() for c in counts], pa.binary()),
                     pa.array([found[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["node", "size", "counts", "shingles"])

    ids = bounded_broadcast(nodes.select("__id").distinct())
    wanted = bounded_broadcast(nodes.select("node").distinct())
    texts = (docs.select(F.col(f"`{id_col}`").alias("__doc"),
                         F.col(f"`{text_col}`").cast("string").alias("__text"))
             .join(ids, F.col("__doc").eqNullSafe(F.col("__id")), "left_semi").select("__text"))
    found = texts.mapInArrow(batches, "node bigint, size bigint, counts binary, shingles binary")
    found = scratch.save(found.join(wanted, "node", "left_semi"))
    # One document was read per node, unless ids are NULL or repeated.
    once = found.groupBy("node").count().filter("count > 1").isEmpty()
    return found if once else scratch.save(found.dropDuplicates(["node"]))


def _needed(total: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of linked sets whose sizes sum to ``total``."""
    return -(-percent * total // (100 + percent))


class CountTree:
    """R-tree over count vectors, packed by sort-tile order, searched level by level."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = self._tile(points, np.arange(len(points)), 0)
        self.points, self.sizes, self.order = points[order], sizes[order], order
        self.levels = []  # from the leaves up: (largest counts, least size, largest size)
        upper, least, most = self.points, self.sizes, self.sizes
        while len(upper) > LEAF or not self.levels:
            starts = np.arange(0, len(upper), LEAF)
            upper = np.maximum.reduceat(upper, starts)
            least, most = np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)
            self.levels.append((upper, least, most))

    @classmethod
    def _tile(cls, points: np.ndarray, index: np.ndarray, axis: int) -> np.ndarray:
        index = index[np.argsort(points[index, axis], kind="stable")]
        leaves = -(-len(index) // LEAF)
        if leaves <= 1 or axis + 1 >= min(4, points.shape[1]):
            return index
        slab = LEAF * -(-leaves // max(1, round(leaves ** 0.5)))
        return np.concatenate([cls._tile(points, index[i:i + slab], axis + 1)
                               for i in range(0, len(index), slab)])

    def search(self, points: np.ndarray, sizes: np.ndarray, percent: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(query, entry)`` index arrays of all pairs that the bound cannot rule out."""
        for low in range(0, len(points), 128):
            q = np.arange(low, min(low + 128, len(points)))
            top = len(self.levels[-1][0])
            query, node = np.repeat(q, top), np.tile(np.arange(top), len(q))
            for level in range(len(self.levels) - 1, -1, -1):
                upper, least, most = self.levels[level]
                query, node = self._cut(points, sizes, query, node, upper, least, most, percent)
                below = len(self.levels[level - 1][0]) if level else len(self.points)
                child = node[:, None] * LEAF + np.arange(LEAF)
                query, node = np.repeat(query, LEAF), child.ravel()
                query, node = query[node < below], node[node < below]
            query, node = self._cut(points, sizes, query, node, self.points, self.sizes,
                                    self.sizes, percent)
            yield query, self.order[node]

    @staticmethod
    def _cut(points, sizes, query, node, upper, least, most, percent):
        own = sizes[query]
        fits = (100 * most[node] >= percent * own) & (percent * least[node] <= 100 * own)
        query, node = query[fits], node[fits]
        keep = np.zeros(len(query), bool)
        step = max(1, (1 << 22) // points.shape[1])
        for at in range(0, len(query), step):
            s = slice(at, at + step)
            least_counts = np.minimum(points[query[s]], upper[node[s]])
            bound = least_counts.sum(1, dtype=np.int64)
            bound[(least_counts == FULL).any(1)] = np.iinfo(np.int64).max
            # The smallest partner a box can hold asks for the least overlap.
            smallest = np.maximum(least[node[s]], -(-percent * sizes[query[s]] // 100))
            keep[s] = bound >= _needed(sizes[query[s]] + smallest, percent)
        return query[keep], node[keep]


def _tree_pairs(table: pa.Table, percent: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(i, j)`` row numbers of pairs of different components that may reach the threshold,
    with the component number of every row."""
    size = table.column("size").to_numpy()
    points = folded(table.column("counts").to_pylist())
    _, group, counts = np.unique(table.column("root").to_numpy(), return_inverse=True, return_counts=True)
    largest = np.argmax(counts)
    # The largest component is searched by all others, never by itself.
    asking = np.flatnonzero(group != largest)
    for q, entry in CountTree(points, size).search(points[asking], size[asking], percent):
        first = asking[q]
        apart = (group[first] != group[entry]) & ((first < entry) | (group[entry] == largest))
        yield first[apart], entry[apart], group


def _involved(percent: int):
    """Arrow function over chunk pairs: the nodes that stand in any pair of the tree."""
    def of(table: pa.Table) -> pa.RecordBatch:
        stands = np.zeros(table.num_rows, bool)
        for i, j, _ in _tree_pairs(table, percent):
            stands[i] = stands[j] = True
        kept = table.select(["family", "first", "second", "node", "root"]).filter(pa.array(stands))
        return kept.combine_chunks().to_batches(max_chunksize=None)[0] if kept.num_rows else (
            pa.RecordBatch.from_pylist([], schema=kept.schema))
    return _per_task(of)


def _joining_links(percent: int):
    """Arrow function over chunk pairs: links that join components.

    Pairs of the tree are verified on the sets here; of those that link, only one leaves
    for every two components that it joins.
    """
    def of(table: pa.Table) -> pa.RecordBatch:
        node = table.column("node").to_numpy()
        sets = [np.frombuffer(x, U64) for x in table.column("shingles").to_pylist()]
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                x = up
            return x

        found = []
        for first, second, group in _tree_pairs(table, percent):
            for i, j in zip(first.tolist(), second.tolist()):
                x, y = top(int(group[i])), top(int(group[j]))
                if x != y:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        parent[x] = y
                        found.append((node[i], node[j]))
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    return _per_task(of)


def _per_task(of):
    """An Arrow function that gives ``of`` the rows of one (family, first, second) at a time."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for part in parts:
            tags = list(zip(*(part.column(c).to_pylist() for c in ("family", "first", "second"))))
            cuts = [0, *(i for i in range(1, len(tags)) if tags[i] != tags[i - 1]), len(tags)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                if low == high:
                    continue
                if held and tags[low] != name:
                    yield of(pa.Table.from_batches(held))
                    held = []
                name = tags[low]
                held.append(part.slice(low, high - low))
        if held:
            yield of(pa.Table.from_batches(held))
    return batches


def _of(members: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """The members that stand in ``pairs``; the list of wanted nodes is broadcast if small."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return members.join(bounded_broadcast(nodes), "node", "left_semi").select("node", *columns)


def _both(pairs: DataFrame, members: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` with the columns of ``a`` (prefix ``x_``) and of ``b`` (prefix ``y_``).

    Sets and vectors are large values: they are merged by node, never broadcast.
    """
    some = _of(members, pairs, columns).hint("merge")
    for key, prefix in (("a", "x_"), ("b", "y_")):
        pairs = pairs.join(some.select(F.col("node").alias(key), *[
            F.col(c).alias(prefix + c) for c in columns]), key)
    return pairs


def overlap_bounds(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``(a, b, total, bound)``: summed sizes and the summed minima of the count vectors."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            total = part.column("x_size").to_numpy() + part.column("y_size").to_numpy()
            bound = np.empty(part.num_rows, np.int64)
            for i, pair in enumerate(zip(part.column("x_counts"), part.column("y_counts"))):
                least = folded([c.as_py() for c in pair]).min(0)
                bound[i] = total[i] if (least == FULL).any() else least.sum(dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(total), pa.array(bound)],
                names=["a", "b", "total", "bound"])

    both = _both(pairs, members, ["size", "counts"])
    return both.select("a", "b", "x_size", "y_size", "x_counts", "y_counts").mapInArrow(
        batches, "a bigint, b bigint, total bigint, bound bigint")


def verified(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = np.zeros(part.num_rows, bool)
            for i, pair in enumerate(zip(part.column("x_shingles"), part.column("y_shingles"))):
                p, q = (np.frombuffer(z.as_buffer(), U64) for z in pair)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(p) + len(q) - both)
            yield part.filter(pa.array(keep)).select(["a", "b"])

    both = _both(pairs.select("a", "b"), members, ["shingles"])
    return both.select("a", "b", "x_shingles", "y_shingles").mapInArrow(
        batches, "a bigint, b bigint")


def joined_families(families: DataFrame, scored: DataFrame, percent: int) -> DataFrame:
    """Families whose smallest node is near another family's smallest node are one.

    A family moves to the smallest such family only (one step, no chains): the families
    of one group of near copies hold the same nodes, which are then moved and searched
    once. No pair of a family is lost by it.
    """
    near = scored.filter(100 * F.col("bound") >= percent * (F.col("total") - F.col("bound")))
    target = (near.select(F.col("a").alias("target"), F.col("b").alias("family"))
              .groupBy("family").agg(F.min("target").alias("target")))
    return (families.join(target, "family", "left")
            .select(F.coalesce("target", "family").alias("family"), "node").distinct())


def residual_links(families: DataFrame, roots: DataFrame, members: DataFrame, scratch, percent: int,
                   chunk_nodes: int = CHUNK_NODES) -> DataFrame:
    """Links that join components inside families that still hold several.

    A family of two was compared whole with its smallest node. One of more than
    ``chunk_nodes`` nodes or ``CHUNK_SHINGLES`` shingles is dealt in chunks; every two
    chunks of it meet in a task of their own. A chunk pair gives fewer links than it has
    nodes, however many of its pairs are near.
    """
    known = (families.join(roots, "node", "left")
             .select("family", "node", F.coalesce("root", "node").alias("root"))
             .join(members.select("node", "size"), "node"))
    open_ones = (known.groupBy("family").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"),
        F.min("root").alias("r0"), F.max("root").alias("r1"))
        .filter("r0 != r1 AND n > 2")
        .select("family", F.ceil(F.greatest(F.col("n") / chunk_nodes,
                                            F.col("shingles") / CHUNK_SHINGLES)).alias("chunks")))
    dealt = (known.join(open_ones, "family")
             .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
             # Every two chunks meet; the only chunk of a family meets nobody.
             .select("family", "node", "root", "chunk", F.explode(
                 F.when(F.col("chunks") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(F.array_remove(
                     F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1), F.col("chunk")))).alias("other"))
             .select("family", F.least("chunk", "other").alias("first"),
                     F.greatest("chunk", "other").alias("second"), "node", "root"))
    tag = ["family", "first", "second"]

    def tasks(rows: DataFrame, columns: list[str]) -> DataFrame:
        wanted = bounded_broadcast(rows.select("node").distinct())
        some = members.join(wanted, "node", "left_semi").select("node", *columns)
        held = rows.join(some.hint("merge"), "node")
        return held.repartition(*tag).sortWithinPartitions(*tag)

    # Sets are large: only those of nodes that the tree could not rule out are moved.
    involved = scratch.save(tasks(dealt, ["size", "counts"]).mapInArrow(
        _involved(percent), "family bigint, first bigint, second bigint, node bigint, root bigint"))
    return tasks(involved, ["size", "counts", "shingles"]).mapInArrow(
        _joining_links(percent), "a bigint, b bigint").distinct()


def block_families(keys: DataFrame, nodes: DataFrame, scratch, full: int = FULL_BLOCK) -> DataFrame:
    """``(family, node)`` of blocks ``(node, key)``: those of one smallest node are a family.

    Of its blocks of more than ``full`` nodes a node leaves the fullest, as many as
    ``spare`` of ``nodes`` says for their space. No linked pair is lost by it
    (see ``group_keys``).
    """
    together = Window.partitionBy("key")
    least_most = {"family": F.min("node").over(together), "most": F.max("node").over(together)}
    large = F.col("n") > full
    # Of a small block only its family matters from here on, of a full one its key.
    shared = scratch.save(
        keys.withColumns(least_most | {"n": F.count(F.lit(1)).over(together)}).filter("family != most")
        .select(F.when(large, F.col("key")).alias("key"), F.when(large, F.col("n")).alias("n"), "family", "node")
        .distinct())
    space = F.col("key").bitwiseAND(F.lit(1).cast("bigint"))
    fullest = Window.partitionBy("node", space).orderBy(F.desc("n"), "key")
    kept = (shared.filter("key IS NOT NULL").withColumn("place", F.row_number().over(fullest))
            .join(nodes.select("node", "spare"), "node")
            .filter(F.col("place") > F.element_at("spare", space.cast("int") + 1))
            .select("key", "node").withColumns(least_most).filter("family != most"))
    return (shared.filter("key IS NULL").select("family", "node")
            .unionByName(kept.select("family", "node")).distinct())


def classified(docs: DataFrame, scratch, id_col: str, text_col: str, words: int, percent: int
               ) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and ``(node, root)`` of every set."""
    rows = scratch.save(signatures(docs, id_col, text_col, words, percent))
    nodes = scratch.save(rows.filter("n_shingles > 0").groupBy("node").agg(
        F.min("__id").alias("__id"), F.min("spare").alias("spare"), F.count(F.lit(1)).alias("copies")))
    # One document's keys stand for each node; a copy's keys are the same ones. Only nodes
    # of several documents are looked up, so the keys of the others need not move for it.
    several = nodes.filter("copies > 1").select("node", F.col("__id").alias("chosen"), "copies")
    keys = (rows.filter("n_shingles > 0").join(bounded_broadcast(several), "node", "left")
            .filter(F.col("copies").isNull() | F.col("__id").eqNullSafe(F.col("chosen")))
            .select("node", F.explode("keys").alias("key")))
    families = scratch.save(block_families(keys, nodes, scratch))
    involved = families.select("node").distinct().join(nodes, "node")
    members = sets(docs, involved, id_col, text_col, words, scratch)
    stars = families.filter("family != node").select(F.col("family").alias("a"),
                                                     F.col("node").alias("b"))
    scored = scratch.save(overlap_bounds(stars, members))
    possible = scored.filter(F.col("bound") * (100 + percent) >= percent * F.col("total"))
    links = scratch.save(verified(possible, members, percent))
    roots = scratch.save(components(links, scratch))
    wide = scratch.save(joined_families(families, scored, NEAR_PERCENT))
    more = scratch.save(residual_links(wide, roots, members, scratch, percent))
    whole = scratch.save(components(links.unionByName(more), scratch))
    return rows, nodes.join(whole, "node", "left").select(
        "node", "__id", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, scratch, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``(id, n_shingles, component_id)``.

    ``component_id`` is the smallest id reachable over links, the document itself
    included. Texts without words (NULL, empty) have no shingles, no links and
    their own id. Rows without an id take part, lend no id, and get the component's
    (NULL if none has one). Repeated rows keep a row each; other columns are
    ignored; an empty table gives no rows.
    """
    rows, placed = classified(docs, scratch, id_col, text_col, words, percent)
    names = placed.groupBy("root").agg(F.min("__id").alias("component_id"))
    classes = placed.join(names, "root").select("node", "component_id")
    return (rows.select("__id", "n_shingles", "node").join(classes, "node", "left")
            .select(F.col("__id").alias(id_col), "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("__id")).alias("component_id")))


def keep_one(docs: DataFrame, scratch, id_col: str = "doc_id", text_col: str = "text",
             words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every group of near copies, its columns unchanged.

    The row of smallest id stays (a row without an id only if its group has none; ties
    by the hash of the text, then of the whole row), so rows of one id are judged each by
    their own text, and no text leaves without a near copy that stays. Texts without
    words are copies of nothing: all of them stay. An empty table gives no rows.
    """
    rows, placed = classified(docs, scratch, id_col, text_col, words, percent)
    ordered = F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"),
                       F.col("text_hash").alias("hash"))
    members = (rows.filter("n_shingles > 0").join(placed.select("node", "root"), "node")
               .groupBy("root", ordered.alias("row")).agg(F.count(F.lit(1)).alias("copies")))
    members = scratch.save(members)
    best = members.groupBy("root").agg(F.min("row").alias("best"))
    judged = scratch.save(members.join(best, "root").select(
        "row.id", "row.hash", F.when(F.col("row") == F.col("best"), F.col("copies")).otherwise(0).alias("copies"))
        .filter("copies != 1"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(f"`{id_col}`").alias("doc"), text_hash(text_col).alias("text_hash"))
    marked = packed.join(bounded_broadcast(judged), F.col("doc").eqNullSafe(F.col("id"))
                         & (F.col("text_hash") == F.col("hash")), "left")
    # Rows repeated whole or in id and text: the one of smallest hash.
    whole = Window.partitionBy("doc", "text_hash").orderBy(F.xxhash64("row"))
    once = marked.filter("copies > 1").withColumn("nth", F.row_number().over(whole)).filter("nth = 1")
    return marked.filter("copies IS NULL").select("row.*").unionByName(once.select("row.*"))
