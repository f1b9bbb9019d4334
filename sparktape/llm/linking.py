"""From band keys to components: candidates, exact verification, union-find.

No group is ever gathered in one task, and no task emits all pairs of a group. Band keys are
shuffled in blocks, and of a bucket (the nodes with one band key) each block sends no more
than two nodes to one task, so that a hot one spreads over tasks; each node is first paired
with the most central node that it meets.
What such stars leave open, two nodes of a bucket in different components, is compared in
blocks of bounded size by signature, and every pair that may be similar is verified exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import estimate
from .tables import in_filter, key_filter, lean, materialise

# Nodes on either side of a block of comparisons.
BLOCK = 512
# Pairs that a task compares at once.
PAIRS_AT_ONCE = 20_000
# Band keys that a task sorts at once before they are shuffled.
KEYS_AT_ONCE = 1 << 20
# Ranges of band keys for each partition of a shuffle.
RANGES = 16
# Nodes in a row of those that need no further company.
SURE_NODES = 4096

_BLOCKS = "part long, sure boolean, key array<long>, node array<long>"
_MEMBERS = "key long, node long, edge boolean, alone boolean"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the buckets of two or more, from rows sorted by key.

    The first and the last bucket of a task may go on in another one; they also yield a row
    marked `edge` with one of their nodes, `alone` if it is the only one in the task.
    """

    def out(key, node, edge, alone) -> pa.RecordBatch:
        columns = [pa.array(np.asarray(x, np.int64)) for x in (key, node)]
        columns += [pa.array(np.full(len(key), edge)), pa.array(np.asarray(alone, bool))]
        return pa.RecordBatch.from_arrays(columns, ["key", "node", "edge", "alone"])

    first = None  # the first bucket: key, node, alone
    last = None  # the bucket that may go on: likewise; its node is not yet out while alone
    for batch in batches:
        key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(key):
            continue
        goes_on = last is not None and last[2] and key[0] == last[0]
        if goes_on:  # the node held back has company now
            key, node = np.insert(key, 0, last[0]), np.insert(node, 0, last[1])
        new = np.ones(len(key) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        single = new[1:] & new[:-1]
        if last is not None and not goes_on and key[0] == last[0]:
            single[0] = False
        if first is None or (first[0] == key[0] and first[2]):
            first = (key[0], node[0] if first is None else first[1], bool(single[0]))
        last = (key[-1], node[-1], bool(single[-1]))
        keep = ~single
        if keep.any():
            yield out(key[keep], node[keep], False, np.zeros(keep.sum()))
    if first is not None:
        edges = {first[0]: first, last[0]: last if last[0] != first[0] else first}
        rows = list(edges.values())
        yield out([r[0] for r in rows], [r[1] for r in rows], True, [r[2] for r in rows])


def _keys_and_nodes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A key and its node for each row, or for each element where rows have lists of keys."""
    key, node = batch.column(0), batch.column(1).to_numpy()
    if pa.types.is_list(key.type):
        sizes = pc.fill_null(pc.list_value_length(key), 0).to_numpy(zero_copy_only=False)
        key, node = key.flatten(), np.repeat(node, sizes)
    return key.to_numpy(), node


def _key_blocks(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keys and nodes as lists, one row for each of `parts` ranges of keys.

    Of a key that is there three times or more, two nodes go with its range; the others are
    in company whatever else the range gets, and go anywhere as `sure` ones.
    """

    def out(part, sure, key, node, starts) -> pa.RecordBatch:
        offsets = pa.array(np.append(starts, len(key)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (key, node)]
        columns = [pa.array(part.astype(np.int64)), pa.array(np.full(len(part), sure)), *lists]
        return pa.RecordBatch.from_arrays(columns, ["part", "sure", "key", "node"])

    def blocks(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key, node = (np.concatenate(x) for x in zip(*held, strict=True))
        order = key.view(np.uint64).argsort()
        key, node = key[order], node[order]
        sure = np.zeros(len(key), bool)
        sure[2:] = key[2:] == key[:-2]
        if sure.any():
            more = node[sure]
            starts = np.arange(0, len(more), SURE_NODES)
            yield out(more[starts].view(np.uint64) % np.uint64(parts), True, key[sure], more, starts)
            key, node = key[~sure], node[~sure]
        part = (key.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        yield out(part[starts], False, key, node, starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_keys_and_nodes(batch))
            n += len(held[-1][0])
            if n >= KEYS_AT_ONCE:
                yield from blocks(held)
                held, n = [], 0
        if n:
            yield from blocks(held)

    return run


def _block_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`_members` of blocks sorted by part; no key is in two parts, so edges tell nothing."""

    def flat(column: pa.ChunkedArray) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(c.flatten().to_numpy() for c in column.chunks)])

    for table in _whole_blocks(batches, ("part",)):
        sure = table.column("sure")
        some = table.filter(sure)
        key, node = flat(some.column("key")), flat(some.column("node"))
        if len(key):
            no = pa.array(np.zeros(len(key), bool))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), no, no], ["key", "node", "edge", "alone"])
        rest = table.filter(pc.invert(sure))
        key, node = flat(rest.column("key")), flat(rest.column("node"))
        order = key.argsort()
        yield from _members(
            iter([pa.RecordBatch.from_arrays([pa.array(key[order]), pa.array(node[order])], ["key", "node"])])
        )


def bucket_members(bands: DataFrame) -> DataFrame:
    """`(key, node, n)`: the nodes of each bucket of two or more, and how many it has.

    `bands` has `(key, node)`; its `key` may be the list of all keys of the node.
    """
    parts = RANGES * int(bands.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = bands.select("key", "node").mapInArrow(lean(_key_blocks(parts)), _BLOCKS)
    found = blocks.repartition("part").sortWithinPartitions("part").mapInArrow(lean(_block_members), _MEMBERS)
    members = materialise(found.where("not edge").select("key", "node"), "bucket-nodes")
    sizes = members.groupBy("key").agg(F.count("*").alias("n"))
    return materialise(members.join(sizes, "key"), "bucket-members")


def central_pairs(members: DataFrame) -> DataFrame:
    """`(a, b)`: each node with the most central other node that it shares a bucket with.

    A node is the more central the more nodes its buckets have: the text that many others
    were made from comes before its copies, which are less like each other than like it.
    """
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = members.join(weight, "node")
    rank = F.struct("weight", "node")
    first = weighed.groupBy("key").agg(F.max(rank).alias("first"))
    beside = weighed.join(first, "key").where(F.col("node") != F.col("first.node"))
    best = beside.groupBy("node").agg(F.max("first").alias("first"))
    return best.select(F.col("node").alias("a"), F.col("first.node").alias("b"))


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """`(node, root)` for the linked nodes, the root being the component's least node.

    Alternates two rewrites of the links until nothing changes: every node's larger
    neighbours move to its least neighbour, then its smaller ones do. Each round is two
    grouped minima and two joins; the number of rounds grows with the logarithm of the
    longest chain.
    """
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = materialise(links.where("u <> v").distinct(), "components")
    state = _fingerprint(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "components")
        now = _fingerprint(links)
        if now == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _whole_blocks(batches: Iterator[pa.RecordBatch], by: tuple[str, ...] = ("key", "i", "j")) -> Iterator[pa.Table]:
    """The rows, sorted by some columns, in tables that do not cut a block of equal ones."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
        if not table.num_rows:
            continue
        marks = [table.column(c).to_numpy() for c in by]
        last = np.all([m == m[-1] for m in marks], axis=0)
        cut = int(last.argmax())
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a column of equally long lists of longs."""
    values = pa.concat_arrays(column.chunks) if column.num_chunks > 1 else column.chunk(0)
    return values.flatten().to_numpy().reshape(len(values), -1)


# Which of the pairs (two arrays of indices) of some contents are similar.
Decide = Callable[[list[bytes], np.ndarray, np.ndarray], np.ndarray]


def _compare(floor: float, decide: Decide | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches):
            key, i, j, left, loose, node, root = (
                table.column(c).to_numpy() for c in ("key", "i", "j", "side", "loose", "node", "root")
            )
            keys, sketch = _matrix(table.column("keys")), _matrix(table.column("sketch")).view(np.uint8)
            band = (keys == key[:, None]).argmax(axis=1)
            contents = table.column("content") if decide is not None else None
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            start = np.flatnonzero(new)
            block = np.cumsum(new) - 1
            n_right = np.bincount(block, ~left, len(start)).astype(np.int64)  # they come first
            rows = np.flatnonzero(left)
            pairs = n_right[block[rows]]
            ends = np.cumsum(pairs)
            low = 0
            while low < len(rows):
                done = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
                some, n = rows[low:high], pairs[low:high]
                a = np.repeat(some, n)
                b = np.repeat(start[block[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                keep = (root[a] != root[b]) & (~loose[b] | (node[b] > node[a]))
                a, b = a[keep], b[keep]
                near = estimate(sketch[a], sketch[b]) >= floor
                a, b = a[near], b[near]
                # A pair is taken in the first bucket that it shares, and only there.
                first = (keys[a] == keys[b]).argmax(axis=1) == band[a]
                a, b = a[first], b[first]
                if decide is not None and len(a):
                    used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
                    similar = decide(contents.take(pa.array(used)).to_pylist(), at[: len(a)], at[len(a) :])
                    a, b = a[similar], b[similar]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])
                low = high

    return run


def _held_udf(wanted) -> Callable[[Column], Column]:
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for nodes in batches:
            yield pa.array(in_filter(wanted.value, nodes.to_numpy(zero_copy_only=False)))

    return F.arrow_udf(lean(run), "boolean")


def open_pairs(
    members: DataFrame,
    roots: DataFrame,
    nodes: DataFrame,
    floor: float,
    contents: DataFrame | None = None,
    decide: Decide | None = None,
) -> DataFrame:
    """Pairs of nodes that share a bucket but no component, and whose sketches suggest a
    similarity of `floor`; with contents, only those that are similar. A bucket's largest component is compared with the others only."""
    named = members.join(roots, "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root")
    )
    parts = named.groupBy("key", "root").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.sum("n").alias("n_all"),
        (F.sum("n") - F.max("n")).alias("n_loose"),
    )
    rows = named.join(mixed.where("n_loose > 0"), "key")
    # Only the members' signatures are shuffled.
    marks = nodes.select("node", "keys", "sketch").where(_held_udf(key_filter(members, F.col("node")))("node"))
    rows = rows.join(marks, "node")
    across, down = F.ceil(F.col("n_all") / BLOCK), F.ceil(F.col("n_loose") / BLOCK)

    def place(blocks: Column) -> Column:
        return F.pmod(F.xxhash64("node"), blocks)

    def every(blocks: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))

    rows = rows.withColumn("loose", F.col("root") != F.col("main"))
    kept = ["key", "node", "root", "loose", "keys", "sketch"]
    if contents is not None:
        rows, kept = rows.join(contents, "node"), [*kept, "content"]
    left = rows.where("loose").select(
        *kept, place(down).alias("i"), every(across).alias("j"), F.lit(True).alias("side")
    )
    right = rows.select(*kept, every(down).alias("i"), place(across).alias("j"), F.lit(False).alias("side"))
    blocks = left.unionByName(right).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    return blocks.mapInArrow(lean(_compare(floor, decide)), "a long, b long")


def _similar_udf(decide: Decide) -> Callable[[Column, Column], Column]:
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = [np.zeros(0, bool)]
            for low in range(0, len(left), 1024):
                one, two = left[low : low + 1024].to_pylist(), right[low : low + 1024].to_pylist()
                at = {content: i for i, content in enumerate(dict.fromkeys([*one, *two]))}
                index = [np.array([at[c] for c in side]) for side in (one, two)]
                out.append(decide(list(at), *index))
            yield pa.array(np.concatenate(out))

    return F.arrow_udf(lean(run), "boolean")


def link_components(
    nodes: DataFrame,
    contents_of: Callable[[DataFrame], DataFrame],
    decide: Decide,
    floor: float,
    *,
    small: bool = False,
) -> DataFrame:
    """`(node, root)` of the nodes that are linked with another one.

    `nodes` has `(node, keys, sketch)`: an id, band keys and the low bits of the signature;
    `contents_of` turns a table of nodes into `(node, content)`; `decide` says which pairs
    of contents are similar. Pairs whose sketches suggest less than `floor` are taken as
    not similar. With `small` contents, pairs are verified where they are compared.
    """
    members = bucket_members(nodes.select(F.col("keys").alias("key"), "node"))
    contents = materialise(contents_of(members.select("node").distinct()), "contents")
    similar = _similar_udf(decide)

    def verified(pairs: DataFrame) -> DataFrame:
        one = contents.select(F.col("node").alias("a"), F.col("content").alias("content_a"))
        two = contents.select(F.col("node").alias("b"), F.col("content").alias("content_b"))
        both = pairs.join(one, "a").join(two, "b")
        return both.where(similar(F.col("content_a"), F.col("content_b"))).select("a", "b")

    links = materialise(verified(central_pairs(members)), "links")
    # One link per node: what it leads to stands for the component that is known so far.
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if small:
        more = open_pairs(members, roots, nodes, floor, contents, decide)
    else:
        more = verified(open_pairs(members, roots, nodes, floor))
    return connected(links.unionByName(materialise(more, "links")))
