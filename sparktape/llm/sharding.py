"""Operator 4: balanced shards by label propagation, with Spark joins only.

Documents are dealt into shards of equal size by a hash, which knows nothing of groups. Then,
round by round until no move is left, each document looks at the shards of its neighbours
and moves to the one that holds most of them, as far as the target has room: for every row
that comes in, one goes out that wants to leave or has no neighbour. Counts stay within one
of each other throughout. Where that leaves links cut, because shards are full of linked
rows, the groups concerned are placed anew in what the others leave free.
"""

from __future__ import annotations

import itertools
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import materialise

SHARDS = 16
# Groups of more than this part of a shard are placed one by one.
LARGE = 64
# Rows that a bucket holds on average when rows are numbered.
BUCKET_ROWS = 4_000


def ranked(
    rows: DataFrame, groups: list[str], order: Column, n_rows: int, name: str, first: Column | None = None
) -> DataFrame:
    """The rows with `name`: their number from 0 within their group.

    Numbers follow buckets of a hash (within `first`, if given, a column of few values), so
    that a group of any size is numbered by many tasks: within a bucket by a window, across
    buckets by a running sum of counts.
    """
    n_buckets = max(1, n_rows // BUCKET_ROWS)
    keys = [*groups, "rank_first", "rank_bucket"]
    keyed = rows.withColumn("rank_first", F.lit(0) if first is None else first)
    keyed = keyed.withColumn("rank_bucket", F.pmod(F.xxhash64(order, F.lit(name)), F.lit(n_buckets)))
    before = Window.partitionBy(*groups).orderBy("rank_first", "rank_bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*keys).agg(F.count("*").alias("rank_n"))
    counts = counts.withColumn("rank_base", F.coalesce(F.sum("rank_n").over(before), F.lit(0)))
    counts = counts.select(*[F.col(k).alias(f"c_{k}") for k in keys], "rank_base")
    inside = Window.partitionBy(*keys).orderBy(order)
    numbered = keyed.withColumn("rank_in", F.row_number().over(inside) - 1)
    same = [F.col(k).eqNullSafe(F.col(f"c_{k}")) for k in keys]
    number = (F.col("rank_in") + F.col("rank_base")).alias(name)
    return numbered.join(counts, same).select(*rows.columns, number)


def chunked(rows: DataFrame, key: str, n_rows: int, shards: int) -> DataFrame:
    """`row, key, at, chunk` of the rows that share their key with others.

    A group larger than a shard is cut into chunks of a shard's size, so that no row has
    more neighbours than a shard has places. `at` numbers the rows of a chunk from 0.
    """
    size = max(1, n_rows // shards)
    repeated = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    rows = rows.join(repeated, key, "left_semi").select("row", key)
    rows = ranked(rows, [key], F.col("row"), n_rows, "at")
    rows = rows.withColumn("chunk", F.floor(F.col("at") / size))
    return materialise(rows.withColumn("at", F.col("at") - F.col("chunk") * size), "shard-groups")


def chunk_links(chunks: DataFrame, key: str) -> DataFrame:
    """Links `(a, b)` between rows of equal key: each row with the first of its chunk."""
    hubs = chunks.groupBy(key, "chunk").agg(F.min("row").alias("hub"))
    links = chunks.join(hubs, [key, "chunk"]).where("row <> hub")
    return links.select(F.col("row").alias("a"), F.col("hub").alias("b"))


def quotas(n_rows: int, shards: int) -> list[int]:
    """Rows of each shard."""
    return [n_rows // shards + (s < n_rows % shards) for s in range(shards)]


def cut_links(placed: DataFrame, links: DataFrame) -> int:
    """Links `(a, b)` whose ends are in different shards of `(row, shard)`."""
    a = placed.select(F.col("row").alias("a"), F.col("shard").alias("shard_a"))
    b = placed.select(F.col("row").alias("b"), F.col("shard").alias("shard_b"))
    return links.join(a, "a").join(b, "b").where("shard_a <> shard_b").count()


def repaired(placed: DataFrame, chunks: DataFrame, key: str, n_rows: int, shards: int) -> DataFrame:
    """`(row, shard)` with the chunks that are cut, and the rows of no chunk, placed anew in
    the places that the whole chunks leave."""
    where = chunks.join(placed, "row").groupBy(key, "chunk").agg(F.count_distinct("shard").alias("n"))
    cut = chunks.join(where.where("n > 1").select(key, "chunk"), [key, "chunk"], "left_semi")
    cut = materialise(cut, "shard-cut")
    settled = chunks.join(where.where("n = 1").select(key, "chunk"), [key, "chunk"], "left_semi")
    settled = materialise(settled.select("row").join(placed, "row").select("row", "shard"), "shard-settled")
    held = dict(settled.groupBy("shard").agg(F.count("*")).collect())  # one row per shard
    free = [q - held.get(s, 0) for s, q in enumerate(quotas(n_rows, shards))]
    rest = placed.select("row").join(settled, "row", "left_anti")
    return settled.unionByName(place_groups(rest, cut, key, n_rows, shards, free))


def _by_runs(at: Column, runs: list[int]) -> Column:
    """The shard whose run of numbers holds `at`: the first `runs[0]` are of shard 0, and so on."""
    shard, low = F.lit(None).cast("int"), 0
    for s, n in enumerate(runs):
        shard = F.when(at.between(low, low + n - 1), F.lit(s)).otherwise(shard)
        low += n
    return shard


def place_groups(
    rows: DataFrame, chunks: DataFrame, key: str, n_rows: int, shards: int, free: list[int] | None = None
) -> DataFrame:
    """`(row, shard)` for rows and chunks of them, in shards of equal size or of the given
    free places, which are as many as the rows. `n_rows` is the size of the whole table.

    Chunks of more than a part in LARGE of a shard are placed whole, best fit in order of
    size. The others follow one after another, over all shards by the places that are left,
    so that at most one lies across each border; rows of no chunk fill up.
    """
    spark = rows.sparkSession
    free = quotas(n_rows, shards) if free is None else list(free)
    sizes = materialise(chunks.groupBy(key, "chunk").agg(F.count("*").alias("size")), "shard-sizes")
    large = sizes.where(F.col("size") * shards * LARGE > n_rows)
    whole = []
    for r in sorted(large.collect(), key=lambda r: (-r["size"], r[key], r["chunk"])):  # LARGE a shard at most
        fits = [s for s in range(shards) if free[s] >= r["size"]]
        if fits:
            into = min(fits, key=lambda s: (free[s], s))
            free[into] -= r["size"]
            whole.append((r[key], r["chunk"], into))
    whole = F.broadcast(spark.createDataFrame(whole, f"{key} string, chunk long, shard int"))
    sizes = sizes.join(whole, [key, "chunk"], "left_anti")
    n_buckets = max(1, n_rows // BUCKET_ROWS)
    sizes = sizes.withColumn("many", -F.ceil(F.log2("size")))
    sizes = sizes.withColumn("bucket", F.pmod(F.xxhash64(key, "chunk"), F.lit(n_buckets)))
    so_far = Window.orderBy("many", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("many", "bucket").orderBy(key, "chunk")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    buckets = sizes.groupBy("many", "bucket").agg(F.sum("size").alias("total"))
    buckets = buckets.withColumn("base", F.coalesce(F.sum("total").over(so_far), F.lit(0))).drop("total")
    before = sizes.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(buckets, ["many", "bucket"])
    before = before.select(key, "chunk", (F.col("base") + F.col("inner")).alias("base"))
    n = sizes.agg(F.sum("size")).first()[0] or 0
    borders = [-(-n * sum(free[:s]) // max(1, sum(free))) for s in range(shards + 1)]
    held = [high - low for low, high in itertools.pairwise(borders)]
    small = chunks.join(before, [key, "chunk"]).select("row", _by_runs(F.col("base") + F.col("at"), held).alias("shard"))
    loose = ranked(rows.join(chunks, "row", "left_anti").select("row"), [], F.col("row"), n_rows, "at")
    left = [f - h for f, h in zip(free, held, strict=True)]
    loose = loose.select("row", _by_runs(F.col("at"), left).alias("shard"))
    return chunks.join(whole, [key, "chunk"]).select("row", "shard").unionByName(small).unionByName(loose)


def _lookup(values: dict[int, int], at: Column) -> Column:
    """The value of a key among a few (one per shard), else null."""
    found = F.lit(None).cast("long")
    for key, value in values.items():
        found = F.when(at == key, F.lit(value).cast("long")).otherwise(found)
    return found


def _accepted(wished: dict[tuple[int, int], int], loose: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many of the rows that wish so go from shard to shard: no shard gains more than
    it has loose rows to send away."""
    flows, net = dict(wished), Counter()
    for (source, target), n in flows.items():
        net[source] -= n
        net[target] += n
    while True:
        over = [t for t in net if net[t] > loose.get(t, 0)]
        if not over:
            return flows
        target = max(over, key=lambda t: (net[t] - loose.get(t, 0), t))
        sources = [s for s, t in flows if t == target and flows[s, t]]
        # The one that can best do without: it gains by what it keeps.
        source = min(sources, key=lambda s: (net[s] - loose.get(s, 0), s))
        n = min(net[target] - loose.get(target, 0), flows[source, target])
        flows[source, target] -= n
        net[target] -= n
        net[source] += n


def propagate(
    rows: DataFrame, links: DataFrame, n_rows: int, *, shards: int = SHARDS, rounds: int | None = None
) -> DataFrame:
    """`(row, shard)` for rows numbered from 0, given links `(a, b)` between row numbers.

    Rows start in their `shard` if they have one, else dealt by number, a hash's order. A row may move to a
    shard that holds more of its neighbours than its own does, if one of them there is
    senior to it: it has more links, or as many and a smaller number. So two neighbours never
    change places for ever, and the hub of a group stays put. A shard takes in, those that
    gain most and those of small groups first, as many rows as leave it for others and as it
    has rows without links; to keep counts as they are, such rows leave it for the shards
    that lost rows. This ends when no row can move, when a round has brought no more
    neighbours together, or after `rounds`.
    """
    spark = rows.sparkSession
    links = links.where("a <> b").distinct()
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialise(both, "shard-links")
    degree = both.groupBy(F.col("a").alias("row")).agg(F.count("*").alias("degree"))
    dealt = F.pmod("row", F.lit(shards)).cast("int")
    placed = rows.select("row", (F.col("shard") if "shard" in rows.columns else dealt).alias("shard"))
    placed = placed.join(degree, "row", "left").select("row", "shard", F.coalesce("degree", F.lit(0)).alias("degree"))
    placed = materialise(placed, "shard-labels")
    near = both.join(degree.select(F.col("row").alias("a"), F.col("degree").alias("degree_a")), "a")
    near = near.join(degree.select(F.col("row").alias("b"), F.col("degree").alias("degree_b")), "b")
    senior = F.struct(-F.col("degree_b"), "b") < F.struct(-F.col("degree_a"), "a")
    near = materialise(near.select("a", "b", senior.cast("int").alias("senior"), "degree_b"), "shard-links")
    best_so_far, kept = -1, placed
    for turn in itertools.count():
        votes = near.join(placed.select(F.col("row").alias("b"), F.col("shard").alias("to")), "b")
        votes = votes.groupBy(F.col("a").alias("row"), "to").agg(
            F.count("*").alias("votes"), F.max("senior").alias("senior"), F.max("degree_b").alias("crowd")
        )
        votes = votes.join(placed, "row")
        here = F.max(F.when(F.col("to") == F.col("shard"), F.col("votes")))
        away = (F.col("to") != F.col("shard")) & (F.col("senior") == 1)
        best = F.max(F.when(away, F.struct("votes", (-F.col("to")).alias("to"), "crowd")))
        wish = votes.groupBy("row", "shard").agg(F.coalesce(here, F.lit(0)).alias("here"), best.alias("best"))
        wish = materialise(wish, "shard-wishes")
        together = wish.agg(F.sum("here")).first()[0] or 0
        if together <= best_so_far:
            break
        best_so_far, kept = together, placed
        if turn == rounds:
            break
        gain = F.col("best.votes") - F.col("here")
        # Those that gain most go first, and among them those of the smallest groups.
        few = F.ceil(F.log2("best.crowd")) - 64 * F.least(gain, F.lit(16))
        wish = wish.where(gain > 0).select("row", "shard", (-F.col("best.to")).alias("target"), few.alias("few"))
        # At most one row per pair of shards, and one per shard.
        wished = {(r["shard"], r["target"]): r["n"] for r in wish.groupBy("shard", "target").agg(F.count("*").alias("n")).collect()}
        loose = dict(placed.where("degree = 0").groupBy("shard").agg(F.count("*")).collect())
        flows = [(s, t, n) for (s, t), n in _accepted(wished, loose).items() if n]
        if not flows:
            break
        room = F.broadcast(spark.createDataFrame(flows, "shard int, target int, room long"))
        wish = ranked(wish, ["shard", "target"], F.xxhash64("row"), n_rows, "at", F.col("few"))
        moves = wish.join(room, ["shard", "target"]).where("at < room").select("row", "target")
        net = dict.fromkeys(range(shards), 0)
        for source, target, n in flows:
            net[source] -= n
            net[target] += n
        moved = materialise(placed.join(moves, "row", "left"), "shard-moves")
        placed = materialise(_carry_out(moved, net, n_rows), "shard-labels")
    return kept.select("row", "shard")


def _carry_out(moved: DataFrame, net: dict[int, int], n_rows: int) -> DataFrame:
    """Makes the moves, and sends rows without links from the shards that gained to those that lost."""
    base, at = {}, 0
    for shard, n in net.items():
        if n > 0:
            base[shard], at = at, at + n
    spot = F.col("at") + _lookup(base, F.col("shard"))
    arrive, at = F.lit(None).cast("int"), 0
    for shard, n in net.items():
        if n < 0:
            arrive = F.when(spot.between(at, at - n - 1), F.lit(shard)).otherwise(arrive)
            at -= n
    loose = moved.where(F.col("degree") == 0).select("row", "shard")
    loose = ranked(loose, ["shard"], F.xxhash64("row", F.lit("out")), n_rows, "at")
    sent = loose.where(F.col("at") < _lookup({s: n for s, n in net.items() if n > 0}, F.col("shard")))
    sent = sent.select("row", arrive.alias("arrive"))
    shard = F.coalesce("arrive", "target", "shard").alias("shard")
    return moved.join(sent, "row", "left").select("row", shard, "degree")


def shard_documents(docs: DataFrame, *, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """One row per document: `doc_id, size, text_crc32, shard, slot`.

    Documents with equal texts are linked; null texts are equal to each other. Counts per
    shard are at most one apart; within that, linked documents are brought together.
    `size` is the UTF-8 length plus one (a null text has none, so 1); a null text has the
    checksum of an empty one. `slot` numbers a shard's rows from 0. Rows of one doc_id are
    documents of their own. No documents give no rows.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("text_key"),
    )
    rows = materialise(rows, "shard-rows")
    n_rows = rows.count()
    order = F.xxhash64("doc_id", "text_key")
    rows = materialise(ranked(rows, [], order, n_rows, "row"), "shard-rows")
    chunks = chunked(rows, "text_key", n_rows, shards)
    links = materialise(chunk_links(chunks, "text_key"), "shard-pairs")
    placed = propagate(rows.select("row"), links, n_rows, shards=shards, rounds=rounds)
    n_cut = cut_links(placed, links)
    if n_cut:
        for again in (repaired(placed, chunks, "text_key", n_rows, shards), place_groups(rows, chunks, "text_key", n_rows, shards)):
            again = materialise(again, "shard-repaired")
            left = cut_links(again, links)
            if left < n_cut:
                n_cut, placed = left, again
    out = ranked(placed, ["shard"], F.col("row"), n_rows, "slot")
    return rows.join(out, "row").select("doc_id", "size", "text_crc32", "shard", "slot")
