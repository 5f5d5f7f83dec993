"""Hard negatives of anchors by a cover tree over norm-augmented candidates.

Each candidate gets one more coordinate, which brings all to one norm M. For an anchor q, whose added
coordinate is zero, a candidate x then has |q - x|^2 = |q|^2 + M^2 - 2 <q, x>: large products are small
distances, and a ball around a node's centre bounds the products of all below it from both sides.

Candidates are dealt into blocks of near ones, and each block holds a cover tree. The children of a
node are centres that cover its points within a radius that shrinks from level to level; where centres
would cover little more than themselves, the points become leaves, shells around the node's centre. A
search goes down level by level, keeps the nodes whose bounds meet a window of wanted products and can
still beat the worst result so far, and takes the leaves best bound first, comparing them exactly.

Anchors meet the blocks in waves of bounded size, each broadcast, so that candidates are never shuffled
again and a task holds one block and one wave's results.
"""

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commwatch.llm.storage import map_arrow, ship_package, stored
from commwatch.session import shared_dir

PIVOTS = 64  # candidates, drawn by hash, whose nearest one deals out the others
BLOCK_ROWS = 2048
LEAF_ROWS = 64
SHRINK = 1.3  # radius of a level against that below
WAVE = 4096  # anchors searched for at once
SEEDS = 32  # one block of so many is searched first, for thresholds
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
POINTS = "row long, vec_id long, label long, anchor boolean, cell int, point binary"
TREE = (
    "block long, n int, rows binary, ids binary, labels binary, points binary, nodes int, "
    "parent binary, centre binary, inner binary, outer binary, first binary, last binary, "
    "level binary"
)
FOUND = "query int, place int, score long, vec_id long, row long"
MINED = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)


# --- cover tree of a block


def _distances(points, norms, centre, rows):
    square = norms[centre] + norms[rows] - 2 * (points[rows] @ points[centre])
    return np.sqrt(np.maximum(square, 0))


def _cover(points, norms, rows, away, most):
    """Centres among some rows, each with the rows it covers within ``away``.

    The first row is the first centre; the next one is always the row furthest from the last. None
    where more than ``most`` centres are needed.
    """
    children, centre = [], rows[0]
    while len(rows):
        if len(children) >= most:
            return None
        d = _distances(points, norms, centre, rows)
        near = d <= away
        children.append((centre, rows[near]))
        rows, far = rows[~near], d[~near]
        if len(rows):
            centre = rows[np.argmax(far)]
    return children


def cover_tree(points, leaf_rows=LEAF_ROWS, shrink=SHRINK):
    """Order of the points and, level by level, the nodes of their cover tree.

    A node has its parent, its centre (a point), the least and greatest distance of its points from
    that, and where they lie in the order. Nodes without children are leaves.
    """
    norms = (points * points).sum(1)
    nodes, order = [], []
    top = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    pending = [(-1, 0, top, np.arange(len(points)))]
    # depth first, so that the points of a node lie together
    while pending:
        parent, level, centre, rows = pending.pop()
        d = _distances(points, norms, centre, rows)
        number = len(nodes)
        outer = float(d.max())
        nodes.append([parent, level, centre, float(d.min()), outer, len(rows)])
        children = None
        if len(rows) > leaf_rows and outer > 0:
            own = np.concatenate([[centre], rows[rows != centre]])
            children = _cover(points, norms, own, outer / shrink, len(rows) // 4)
        if children and len(children) > 1:
            pending += [(number, level + 1, c, r) for c, r in children]
        elif len(rows) > leaf_rows:
            by_distance = np.argsort(d, kind="stable")
            for k in range(0, len(rows), leaf_rows):
                shell = by_distance[k : k + leaf_rows]
                nodes.append(
                    [number, level + 1, centre, float(d[shell[0]]), float(d[shell[-1]]), len(shell)]
                )
                order.append((len(nodes) - 1, rows[shell]))
        else:
            order.append((number, rows))
    table = np.array([n[:3] for n in nodes], np.int64).reshape(-1, 3)
    reach = np.array([n[3:5] for n in nodes]).reshape(-1, 2)
    first, last = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
    at = 0
    for leaf, rows in order:
        first[leaf], last[leaf] = at, at + len(rows)
        at += len(rows)
    return np.concatenate([rows for _, rows in order]), table, reach, first, last


def _augmented(points, most):
    """Points with the coordinate that brings them to the squared norm ``most``."""
    square = (points * points).sum(1)
    return np.concatenate([points, np.sqrt(np.maximum(most - square, 0))[:, None]], axis=1)


def _grown(batches, dims, most, block_rows):
    """Blocks of neighbouring rows, each with its cover tree."""
    number = TaskContext.get().partitionId() << 32
    names = [c.split()[0] for c in TREE.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int32(), *[pa.binary()] * 7]
    held, n = [], 0

    def told(part):
        nonlocal number
        rows, ids, labels = (part.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        points = np.frombuffer(b"".join(part.column("point").to_pylist()), np.int64).reshape(-1, dims)
        order, table, reach, first, last = cover_tree(_augmented(points.astype(np.float64), most))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        value = (
            number, len(rows), rows[order], ids[order], labels[order], points[order], len(table),
            table[:, 0], place[table[:, 2]], reach[:, 0], reach[:, 1], first, last, table[:, 1],
        )
        number += 1
        cells = [np.ascontiguousarray(v).tobytes() if isinstance(v, np.ndarray) else v for v in value]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names)

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= block_rows:
            whole = pa.Table.from_batches(held).combine_chunks()
            cut = n - n % block_rows
            for k in range(0, cut, block_rows):
                yield told(whole.slice(k, block_rows).combine_chunks())
            held, n = whole.slice(cut).to_batches(), n - cut
    if n:
        yield told(pa.Table.from_batches(held).combine_chunks())


class _Block:
    """A block as it comes from the index."""

    def __init__(self, batch, row, dims):
        def column(name, kind=np.int64):
            return np.frombuffer(batch.column(name)[row].as_buffer(), kind)

        self.rows, self.ids, self.labels = column("rows"), column("ids"), column("labels")
        self.points = column("points").reshape(-1, dims)
        self.parent, self.centre = column("parent"), column("centre")
        self.inner, self.outer = column("inner", np.float64), column("outer", np.float64)
        self.first, self.last, self.level = column("first"), column("last"), column("level")


# --- search


class _Results:
    """The best results so far of each query and place, best first."""

    def __init__(self, queries, places, most):
        self.most, self.places = most, places
        self.score = np.full((queries * places, most), LOWEST, np.int64)
        self.ids = np.full((queries * places, most), HIGHEST, np.int64)
        self.rows = np.full((queries * places, most), -1, np.int64)

    def add(self, slot, score, ids, rows):
        """Merge results in, each for its slot."""
        touched, own = np.unique(slot, return_inverse=True)
        every = np.concatenate([np.repeat(np.arange(len(touched)), self.most), own])
        s = np.concatenate([self.score[touched].ravel(), score])
        i = np.concatenate([self.ids[touched].ravel(), ids])
        r = np.concatenate([self.rows[touched].ravel(), rows])
        order = np.lexsort((r, i, ~s, every))
        group = every[order]
        rank = np.arange(len(order)) - np.searchsorted(group, group)
        kept = order[rank < self.most]
        for have, new in ((self.score, s), (self.ids, i), (self.rows, r)):
            have[touched] = new[kept].reshape(-1, self.most)


def _exact(queries, points, largest):
    """Whole-number products, by floating point where that is exact."""
    if largest < 1 << 53:
        return np.rint(queries.astype(np.float64) @ points.astype(np.float64).T).astype(np.int64)
    return queries @ points.T


def _search_block(block, wave, results, dims):
    """Merge a block's results for all queries of a wave."""
    points, square, most, same = wave["points"], wave["square"], wave["most"], wave["same"]
    low, high, least = wave["low"], wave["high"], wave["least"]
    q = len(points)
    floats = points.astype(np.float64)
    # rounding of the products and square roots below
    slack = 1e-9 * (square + most) + 1e-6
    places = low.shape[1]
    worst = np.maximum(results.score[:, -1].reshape(q, places), least)

    def useful(upper, lower, who):
        alive = np.zeros(upper.shape, bool)
        for w in range(places):
            floor = np.maximum(low[who, w], worst[who, w])[:, None]
            alive |= (upper >= floor) & (lower <= high[who, w][:, None])
        return alive

    def bounds(nodes, who):
        centre = block.points[block.centre[nodes]].astype(np.float64)
        total = (square[who] + most)[:, None]
        d = np.sqrt(np.maximum(total - 2 * (floats[who] @ centre.T), 0))
        near = np.maximum(np.maximum(d - block.outer[nodes], block.inner[nodes] - d), 0)
        far = d + block.outer[nodes]
        slip = slack[who][:, None]
        return (total - near * near) / 2 + slip, (total - far * far) / 2 - slip

    if same and not np.isin(wave["labels"], block.labels).any():
        return
    alive = {}
    leaves, uppers, wanted = [], [], []
    with np.errstate(invalid="ignore"):
        for level in range(int(block.level.max()) + 1):
            nodes = np.flatnonzero(block.level == level)
            if level:
                nodes = nodes[[int(p) in alive for p in block.parent[nodes]]]
                if not len(nodes):
                    break
                may = np.stack([alive[int(p)] for p in block.parent[nodes]], axis=1)
            else:
                may = np.ones((q, 1), bool)
                if same:
                    may &= np.isin(wave["labels"], block.labels)[:, None]
            who = np.flatnonzero(may.any(1))
            if not len(who):
                break
            upper, lower = bounds(nodes, who)
            kept = useful(upper, lower, who) & may[who]
            alive = {}
            for k, node in enumerate(nodes.tolist()):
                if kept[:, k].any():
                    asked = np.zeros(q, bool)
                    asked[who] = kept[:, k]
                    if block.last[node] > block.first[node]:
                        reach = np.full(q, -np.inf)
                        reach[who] = upper[:, k]
                        leaves.append(node)
                        uppers.append(reach)
                        wanted.append(asked)
                    else:
                        alive[node] = asked
    best = [float(u[w].max()) for u, w in zip(uppers, wanted)]
    for k in sorted(range(len(leaves)), key=lambda k: -best[k]):
        reach = uppers[k]
        floor = np.maximum(low, worst).min(1)
        who = np.flatnonzero(wanted[k] & (reach >= floor))
        if not len(who):
            continue
        at = slice(int(block.first[leaves[k]]), int(block.last[leaves[k]]))
        score = _exact(points[who], block.points[at], wave["largest"])
        alike = wave["labels"][who][:, None] == block.labels[at]
        fits = alike if same else ~alike
        fits &= wave["rows"][who][:, None] != block.rows[at]
        for w in range(places):
            floor = np.maximum(low[who, w], worst[who, w])[:, None]
            i, j = np.nonzero(fits & (score >= floor) & (score <= high[who, w][:, None]))
            if not len(i):
                continue
            slot = who[i] * places + w
            last, own = results.score[slot, -1], score[i, j]
            beats = (own > last) | (own == last) & (block.ids[at][j] <= results.ids[slot, -1])
            slot, i, j, own = slot[beats], i[beats], j[beats], own[beats]
            if len(slot):
                results.add(slot, own, block.ids[at][j], block.rows[at][j])
                touched = np.unique(slot)
                worst[touched // places, w] = np.maximum(
                    results.score[touched, -1], least[touched // places, w]
                )


def _searched(batches, wave, dims, k):
    """The best results that a task's blocks hold for the queries of a wave."""
    wave = wave.value
    q, places = wave["low"].shape
    results = _Results(q, places, k)
    for batch in batches:
        for row in range(batch.num_rows):
            _search_block(_Block(batch, row, dims), wave, results, dims)
    slot, rank = np.nonzero(results.rows >= 0)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array((slot // places).astype(np.int32)),
            pa.array((slot % places).astype(np.int32)),
            *(pa.array(x[slot, rank]) for x in (results.score, results.ids, results.rows)),
        ],
        ["query", "place", "score", "vec_id", "row"],
    )


def _top(found, k):
    order = Window.partitionBy("query", "place").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(index, wave, dims, k):
    """Best ``k`` rows of the index for each query and window of a wave, with their rank.

    One block of ``SEEDS`` is searched first. Its worst result of a query is a floor that spares
    the other tasks what cannot be among the best of all.
    """
    context = index.sparkSession.sparkContext
    shape = wave["low"].shape

    def run(blocks, sent):
        return _top(map_arrow(blocks, partial(_searched, wave=sent, dims=dims, k=k), FOUND), k)

    sent = context.broadcast(wave | {"least": np.full(shape, LOWEST, np.int64)})
    seeds = index.where(F.pmod(F.xxhash64("block"), F.lit(SEEDS)) == 0)
    floors = run(seeds, sent).where(F.col("rank") == k).select("query", "place", "score").toArrow()
    sent.unpersist()
    least = np.full(shape, LOWEST, np.int64)
    least[floors["query"].to_numpy(), floors["place"].to_numpy()] = floors["score"].to_numpy()
    sent = context.broadcast(wave | {"least": least})
    return run(index, sent), sent


# --- preparation


def _dealt(batches, dims, most, pivots):
    """Points as bytes of ``dims`` whole numbers, missing ones zero, and the nearest pivot of each."""
    if pivots is not None:
        middle = _augmented(pivots.astype(np.float64), most)
    for batch in batches:
        values = batch.column("point")
        size = values.value_lengths().to_numpy(zero_copy_only=False)
        flat = values.flatten().to_numpy(zero_copy_only=False)
        points = np.zeros((batch.num_rows, dims), np.int64)
        points[np.arange(dims) < size[:, None]] = flat
        cell = np.zeros(batch.num_rows, np.int32)
        if pivots is not None:
            own = _augmented(points.astype(np.float64), most)
            cell = np.argmax(own @ middle.T, axis=1).astype(np.int32)
        blobs = [p.tobytes() for p in points]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("row", "vec_id", "label", "anchor")), pa.array(cell),
             pa.array(blobs, pa.binary())],
            ["row", "vec_id", "label", "anchor", "cell", "point"],
        )


def _usable(df, scale):
    """Rows that take part, with ``floor(scale * x)`` of each component and a number of their own."""
    components = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    given = df.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.coalesce(F.col("anchor").cast("boolean"), F.lit(False)).alias("anchor"),
        "embedding",
    )
    rows = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite)
    rows = rows.where(F.size("embedding") > 0)
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") * scale, 2))
    rows = rows.where(square < float(1 << 61)).withColumn("point", components).drop("embedding")
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "points")


def mine_hard_negatives(
    df, scale=256, positives=5, negatives=10, low=30, high=90, wave=WAVE, block_rows=BLOCK_ROWS
):
    """Hard negatives of each anchor and positive: one row per negative, best first.

    ``df`` has ``vec_id``, ``embedding``, ``label`` and the boolean ``anchor``. A component x becomes
    ``floor(scale * x)``; scores are whole-number inner products, higher first, ties by smaller
    ``vec_id``. The positives of an anchor are its first ``positives`` other rows of its label. For
    each of these come the first ``negatives`` rows of other labels whose score is ``low`` to ``high``
    per cent of the positive's: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.

    Rows with a null key, label or vector, or a null or infinite component or none at all, take no part,
    nor do rows so long that their product with themselves passes 2^61; a null ``anchor`` is false.
    Vectors of fewer components than others count as if zeros followed. Rows of one key are rows of
    their own: an anchor's copy may be its positive. An empty table, one without anchors, and anchors
    alone in their label give no rows. Other columns are not read.

    The search is exact. A wave of at most about ``wave`` anchors is read to the driver and broadcast,
    as are their positives' scores; nothing else leaves the executors.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = _usable(df, scale)
    size = F.size("point")
    length = F.aggregate("point", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    facts = rows.agg(
        F.max(size).alias("dims"),
        F.max(length).alias("most"),
        F.count(F.when(F.col("anchor"), 1)).alias("anchors"),
    ).first()
    if not facts.anchors or not facts.dims:
        return spark.createDataFrame([], MINED)
    dims, most = facts.dims, facts.most
    drawn = rows.orderBy(F.xxhash64("row")).limit(PIVOTS).select("point").toArrow()["point"].to_pylist()
    pivots = np.zeros((len(drawn), dims), np.int64)
    for k, p in enumerate(drawn):
        pivots[k, : len(p)] = p
    points = map_arrow(rows, partial(_dealt, dims=dims, most=most, pivots=pivots), POINTS)
    points = stored(points, "dealt")
    by = ("cell", "label", "row")
    sorted_points = points.repartitionByRange(*by).sortWithinPartitions(*by)
    grow = partial(_grown, dims=dims, most=most, block_rows=block_rows)
    index = stored(map_arrow(sorted_points.drop("cell", "anchor"), grow, TREE), "index")
    # products are exact in floating point below 2^53, whatever the order of summation
    largest = int(min(most, 2.0**62)) + 1
    waves = math.ceil(facts.anchors / wave)
    folder = shared_dir(spark, "negatives")
    for number in range(waves):
        mine = points.where("anchor").where(F.pmod(F.xxhash64("row"), F.lit(waves)) == number)
        asked = mine.select("row", "vec_id", "label", "point").toArrow()
        q = asked.num_rows
        if not q:
            continue
        vectors = np.frombuffer(b"".join(asked["point"].to_pylist()), np.int64).reshape(q, dims)
        query = {
            "points": vectors,
            "square": (vectors.astype(np.float64) ** 2).sum(1),
            "rows": asked["row"].to_numpy(),
            "labels": asked["label"].to_numpy(),
            "most": most,
            "largest": largest,
        }
        ends = {"low": np.full((q, 1), LOWEST), "high": np.full((q, 1), HIGHEST)}
        best, sent = _search(index, query | ends | {"same": True}, dims, positives)
        found = best.toArrow()
        sent.unpersist()
        place = found["rank"].to_numpy() - 1
        positive = np.full((q, positives), LOWEST, np.int64)
        at = (found["query"].to_numpy(), place)
        positive[at] = found["score"].to_numpy()
        floor, ceiling = np.full((q, positives), 1, np.int64), np.zeros((q, positives), np.int64)
        for i, k in zip(*(x.tolist() for x in at)):
            score = int(positive[i, k])
            floor[i, k], ceiling[i, k] = -(-low * score // 100), high * score // 100
        empty = floor > ceiling
        floor[empty], ceiling[empty] = HIGHEST, LOWEST
        ends = {"low": floor, "high": ceiling}
        best, sent = _search(index, query | ends | {"same": False}, dims, negatives)
        anchors = asked["vec_id"].to_numpy()[at[0]]
        known = pa.table(
            {
                "query": at[0].astype(np.int32),
                "place": place.astype(np.int32),
                "anchor_id": anchors,
                "positive_id": found["vec_id"],
                "positive_score": found["score"],
            }
        )
        pairs = spark.createDataFrame(known)
        mined = best.join(F.broadcast(pairs), ["query", "place"]).select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        mined.write.parquet(f"{folder}/wave={number}")
        sent.unpersist()
    return spark.read.schema(MINED + ", wave int").parquet(folder).drop("wave")
