"""Documents whose sets of word n-grams are similar, joined by partition and pigeonhole.

Two sets of sizes x and y with a Jaccard similarity of at least t differ in at most
H = (1 - t) / (1 + t) * (x + y) elements. The universe is cut by hash into S segments, more than that,
so the sets agree in at least S - H whole segments.

- Size bands. Sets of sizes 2^b to 2^(b+1) - 1 share one segmentation of three quarters of 2^b
  segments. A set that can be similar to one of the next band is cut in that band's way too.
- Segment subsets by cost. A set tells its H + 1 cheapest segments, those that the fewest sets have,
  counted over all documents; ties go by their hash and empty segments come last, by their place. In
  this one order of all segments two similar sets tell one in common: let w be the first segment that
  they share. Were it not among the first H + 1 of a set, more than H of its segments would come before
  w, none of them shared, and the sets would share less than S - H.
- What many unlike documents have in common, such as a licence, is the dearest and is not told, unless
  it makes up so much of a set that similar ones may differ in all the rest.

Candidates are verified exactly on the texts. Neighbours by one deletion, which let a segment count for
two differences, are not needed: S is greater than H in every band, so whole segments always suffice.
"""

from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commwatch.llm.arrow_text import (
    BASES, chunks, flat, lower_ascii, mix, signed, span_hashes, window_starts, word_hashes,
)
from commwatch.llm.components import components
from commwatch.llm.storage import map_arrow, stored

WIDTH = 5
PERCENT = 80
TRIES = 3  # hubs that a node is compared with in a turn
TURNS = 3
LISTED = 256  # signatures of a node that its rows carry, so that a pair is made in one group only
SKETCH = 4  # numbers of 64 bits
SET_BYTES = 1 << 20  # of the texts whose sets are in memory at once
SETS = "doc_id long, t1 long, node long, n long, " + ", ".join(f"k{i} long" for i in range(SKETCH))


def shingle_sets(column, width=WIDTH):
    """Distinct n-gram hashes of each text: hash and text number, sorted by text, and set sizes."""
    data, at = flat(column)
    words, upto = word_hashes(lower_ascii(data), at)
    first, owner = window_starts(upto, width)
    counts = np.diff(upto)
    short = np.flatnonzero((counts > 0) & (counts < width))
    first = np.concatenate([first, upto[:-1][short]])
    last = np.concatenate([first[: len(first) - len(short)] + width, upto[1:][short]])
    owner = np.concatenate([owner, short])
    h = span_hashes(words, first, last, BASES[0])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[fresh], owner[fresh]
    return h, owner, np.bincount(owner, minlength=len(column))


def _sums(values, owner, n):
    """Sum modulo 2^64 of each owner's values; owners ascend."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    edges = np.searchsorted(owner, np.arange(n + 1))
    return total[edges[1:]] - total[edges[:-1]]


def _nodes(h, owner, sizes):
    """A number for each set; equal sets have equal numbers."""
    return signed(mix(_sums(mix(h + np.uint64(7)), owner, len(sizes)) + sizes.astype(np.uint64)))


def _describe(batches, width):
    """Per document its set's number and size, and the parities of its elements by 256 buckets."""
    for batch in batches:
        for chunk in chunks(batch, most=SET_BYTES):
            h, owner, sizes = shingle_sets(chunk.column("text"), width)
            bits = np.bincount(
                owner * (64 * SKETCH) + (h & np.uint64(64 * SKETCH - 1)).astype(np.int64),
                minlength=len(sizes) * 64 * SKETCH,
            )
            parity = np.packbits((bits & 1).astype(np.uint8)).view(np.int64).reshape(-1, SKETCH)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"),
                    chunk.column("t1"),
                    pa.array(_nodes(h, owner, sizes)),
                    pa.array(sizes.astype(np.int64)),
                    *(pa.array(np.ascontiguousarray(parity[:, i])) for i in range(SKETCH)),
                ],
                [c.split()[0] for c in SETS.split(", ")],
            )


def bands(sizes):
    return np.frexp(sizes.astype(np.float64))[1] - 1


def signatures(h, owner, sizes, band, most, percent=PERCENT):
    """Signatures of sets in the segmentation of a band each: signature and set number.

    All filled segments are told, and of a set with too few of them as many empty ones as it lacks.
    ``most`` is the largest partner to be found there. Sets are told by ``owner``, which ascends. The
    third result says per set how many of its signatures are more than it has to tell.
    """
    segments = (3 << band) // 4 + 2
    needed = (sizes + most) * (100 - percent) // (100 + percent) + 1
    high = (h >> np.uint64(32)).astype(np.int64)
    segment = (high * segments[owner]) >> 32
    order = np.argsort((owner << 33) + segment, kind="stable")
    h, owner, segment = h[order], owner[order], segment[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])
    begin = np.flatnonzero(fresh)
    total = _sums(mix(h + np.uint64(11)), np.cumsum(fresh) - 1, len(begin))
    who, place = owner[begin], segment[begin]
    salt = mix((band[who].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64))
    parts, owners = [mix(total + salt)], [who]
    filled = np.bincount(who, minlength=len(sizes))
    empty = np.flatnonzero((filled < needed) & (sizes > 0))
    if len(empty):
        count = segments[empty]
        at = np.repeat(empty, count)
        seg = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        bare = ~np.isin((at << 33) + seg, (who << 33) + place)
        at, seg = at[bare], seg[bare]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        told = rank < (needed - filled)[at]
        key = (band[at].astype(np.uint64) << np.uint64(40)) + seg.astype(np.uint64)
        parts.append(mix(mix(key))[told])
        owners.append(at[told])
    return np.concatenate(parts), np.concatenate(owners), np.maximum(filled - needed, 0)


def _tell(batches, width, percent):
    """Signatures of all sets; of equal sets in a chunk one tells them.

    ``cut`` is twice the number of signatures that a set may leave out, and one more where it is cut
    in the way of the next band.
    """
    for batch in batches:
        for chunk in chunks(batch, most=SET_BYTES):
            h, owner, sizes = shingle_sets(chunk.column("text"), width)
            nodes = _nodes(h, owner, sizes)
            keep = np.zeros(len(sizes), bool)
            keep[np.unique(nodes, return_index=True)[1]] = True
            keep &= sizes > 0
            number = np.cumsum(keep) - 1
            mine = keep[owner]
            h, owner = h[mine], number[owner[mine]]
            sizes, nodes = sizes[keep].astype(np.int64), nodes[keep]
            band = bands(sizes).astype(np.int64)
            largest = sizes * 100 // percent
            up = largest >= (1 << (band + 1))
            within = np.minimum(largest, (1 << (band + 1)) - 1)
            sig, own, spare = signatures(h, owner, sizes, band, within, percent)
            both = [(sig, own, 2 * spare)]
            if up.any():
                number, mine = np.cumsum(up) - 1, up[owner]
                sig, own, spare = signatures(
                    h[mine], number[owner[mine]], sizes[up], band[up] + 1, largest[up], percent
                )
                above = np.zeros(len(sizes), np.int64)
                above[up] = 2 * spare + 1
                both.append((sig, np.flatnonzero(up)[own], above))
            sig, own = (np.concatenate(x) for x in zip(*((s, o) for s, o, _ in both)))
            cut = np.concatenate([spare[o] for _, o, spare in both])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(sig)), pa.array(nodes[own]), pa.array(cut.astype(np.int32))],
                ["sig", "node", "cut"],
            )


def _verify(batches, width, percent):
    for batch in batches:
        for chunk in chunks(batch, "ta", "tb", most=SET_BYTES):
            h1, o1, n1 = shingle_sets(chunk.column("ta"), width)
            h2, o2, n2 = shingle_sets(chunk.column("tb"), width)
            h, o = np.concatenate([h1, h2]), np.concatenate([o1, o2])
            order = np.lexsort((h, o))
            h, o = h[order], o[order]
            same = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
            shared = np.bincount(o[1:][same], minlength=chunk.num_rows)
            linked = 100 * shared >= percent * (n1 + n2 - shared)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("a"), chunk.column("b"), pa.array(linked)], ["a", "b", "linked"]
            )


def _may_link(x, y, percent):
    """Sizes and parities that similar sets can have: each odd bucket in one alone is a difference."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    odd = sum(
        F.bit_count(F.col(f"{x}.k{i}").bitwiseXOR(F.col(f"{y}.k{i}"))) for i in range(SKETCH)
    )
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & (odd * (100 + percent) <= (n + m) * (100 - percent))
    )


def _sketched(pairs, nodes, percent):
    """Pairs that their sizes and parities allow to be similar."""
    return (
        pairs.join(nodes.alias("x"), F.col("a") == F.col("x.node"))
        .join(nodes.alias("y"), F.col("b") == F.col("y.node"))
        .where(_may_link("x", "y", percent))
        .select(*pairs.columns)
    )


def _links(pairs, nodes, docs, width, percent):
    """The pairs whose sets are similar, compared by their texts."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(needed.join(nodes.select("node", "t1"), "node"), "wanted")
    # only wanted texts are shuffled, and the texts of a copy are one row before that
    held = docs.join(wanted.select("t1"), "t1", "left_semi").groupBy("t1").agg(
        F.first("text").alias("text")
    )
    texts = stored(held.join(wanted, "t1").select("node", "text"), "texts")
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"
    )
    run = partial(_verify, width=width, percent=percent)
    checked = map_arrow(sides.select("a", "b", "ta", "tb"), run, "a long, b long, linked boolean")
    return stored(checked.where("linked").select("a", "b"), "links")


def similar_components(df, width=WIDTH, percent=PERCENT, with_text_hash=False):
    """One row per document: ``doc_id``, ``n_shingles`` and ``component_id``.

    ``with_text_hash`` adds ``text_hash``, which tells rows of one key apart, and ``group``, a
    number of the component that needs no key (null without n-grams).

    A set holds the distinct n-grams of ``width`` words of a text, A to Z in lower case; a shorter
    text is one n-gram. Two documents link when 100 times the shared n-grams are at least
    ``percent`` times all of both. ``component_id`` is the smallest ``doc_id`` that links lead to.

    Null, empty and blank texts have no n-grams and link with nothing, themselves. Null keys are
    passed over in minima: a component of null keys alone has a null id. Repeated rows and equal
    texts are one set and so one component. An empty table gives no rows. Other columns are not
    read. Sets and n-grams are compared by 64-bit hashes.

    1. Documents become sets; equal sets are one node from here on.
    2. Signatures meet in one shuffle, and of signatures that the same nodes tell one is kept. In each group of a signature one node is the hub. A node is
       compared with the few hubs that share most signatures with it, if sizes and parities do not
       rule them out. In the next turns only groups with nodes of several components are left, and
       their hubs are drawn from their commonest component. That joins copies of all kinds at a
       cost of a few comparisons per node and turn, however large their group is.
    3. In the groups that still have several components, nodes outside the commonest one meet the
       others, again if sizes and parities allow it, so that no link between components is lost
       and no pair inside one is looked at.
    """
    rows = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("t1"),
        F.col("text"),
    )
    describe = partial(_describe, width=width)
    sets = stored(map_arrow(rows, describe, SETS), "sets")
    sketch = [f"k{i}" for i in range(SKETCH)]
    nodes = (
        sets.where("n > 0")
        .groupBy("node")
        .agg(F.min("t1").alias("t1"), F.first("n").alias("n"), *(F.first(k).alias(k) for k in sketch))
    )
    nodes = stored(nodes, "nodes")
    tell = partial(_tell, width=width, percent=percent)
    told = map_arrow(rows.select("text"), tell, "sig long, node long, cut int")
    group = Window.partitionBy("sig")

    def shared(frame):
        ends = frame.withColumns({"hub": F.min("node").over(group), "top": F.max("node").over(group)})
        return ends.where("hub <> top").drop("top")

    # a set's signatures that no other has are its cheapest: of those that others have, it leaves
    # out the dearest, as many as it may
    dearest = Window.partitionBy("node", "cut").orderBy(F.desc("cost"), F.desc("sig"))
    costed = shared(told.withColumn("cost", F.count(F.lit(1)).over(group)))
    ranked = costed.withColumn("rank", F.dense_rank().over(dearest))
    cheap = ranked.where(F.col("rank") > F.shiftright("cut", 1)).select("sig", "node")
    # groups of the same nodes say the same: one of them is kept
    prints = {f"p{i}": F.bit_xor(F.xxhash64("node", F.lit(i))).over(group) for i in range(2)}
    alike = shared(cheap.distinct()).withColumns(prints).groupBy("p0", "p1", "node")
    groups = stored(alike.agg(F.min("sig").alias("sig"), F.first("hub").alias("hub")), "groups")

    def labelled(frame, labels, column="node", name="c"):
        named = labels.select(F.col("v").alias(column), F.col("c").alias(name))
        return frame.join(named, column, "left").withColumn(name, F.coalesce(name, column))

    def mixed_groups(frame, labels):
        """Groups with nodes of several components, and the commonest of these."""
        marked = labelled(frame.select("sig", "node"), labels)
        lowest, highest = F.min("c").over(group), F.max("c").over(group)
        common = marked.withColumns({"mixed": lowest < highest, "common": F.mode("c").over(group)})
        return stored(common.where("mixed").drop("mixed"), "mixed")

    def tries(pairs, turn):
        """Of the hubs that each node meets, the few with most groups in common, as pairs."""
        met = pairs.groupBy("node", "hub").agg(F.count("*").alias("shared"))
        met = met.select(F.col("node").alias("a"), F.col("hub").alias("b"), "shared")
        if tested:
            done = reduce(lambda x, y: x.unionByName(y), tested)
            both = done.unionByName(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
            met = met.join(both, ["a", "b"], "left_anti")
        rank = F.row_number().over(
            Window.partitionBy("a").orderBy(F.desc("shared"), F.xxhash64("b", F.lit(turn)))
        )
        few = _sketched(met, nodes, percent).withColumn("rank", rank).where(F.col("rank") <= TRIES)
        return stored(few.select("a", "b").distinct(), "pairs")

    tested, links = [], []

    def test(pairs):
        tested.append(pairs)
        links.append(_links(pairs, nodes, rows, width, percent))
        return stored(components(reduce(lambda x, y: x.unionByName(y), links)), "components")

    labels = test(tries(groups.where("node <> hub").select("node", "hub"), 0))
    mixed = mixed_groups(groups, labels)
    for turn in range(1, TURNS):
        member = F.when(F.col("c") == F.col("common"), F.col("node"))
        drawn = F.xxhash64("sig", "node", F.lit(turn))
        pairs = mixed.withColumn("hub", F.max_by(member, F.when(member.isNotNull(), drawn)).over(group))
        pairs = tries(pairs.where("c <> common").select("node", "hub"), turn)
        if pairs.isEmpty():
            break
        labels = test(pairs)
        mixed = mixed_groups(mixed, labels)
    told_all = stored(
        mixed.join(nodes, "node").select("sig", "node", "c", "common", "n", *sketch), "told"
    )
    # a pair is made in the first group that has both; nodes of very many groups make it in each
    lists = told_all.groupBy("node").agg(F.collect_list("sig").alias("sigs"))
    lists = lists.where(F.size("sigs") <= LISTED)
    told_all = told_all.join(lists, "node", "left").withColumn(
        "before", F.coalesce(F.expr("filter(sigs, s -> s < sig)"), F.expr("cast(array() AS array<bigint>)"))
    )
    x, y = told_all.where("c <> common").alias("x"), told_all.alias("y")
    across = x.join(
        y,
        (F.col("x.sig") == F.col("y.sig"))
        & (F.col("x.c") != F.col("y.c"))
        & ((F.col("y.c") == F.col("y.common")) | (F.col("x.node") < F.col("y.node")))
        & _may_link("x", "y", percent)
        & ~F.arrays_overlap("x.before", "y.before"),
    ).select(
        F.least("x.node", "y.node").alias("a"),
        F.greatest("x.node", "y.node").alias("b"),
    )
    done = reduce(lambda p, q: p.unionByName(q), tested).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    more = across.distinct().join(done, ["a", "b"], "left_anti")
    more = stored(more, "pairs")
    if not more.isEmpty():
        labels = test(more)
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    known = labelled(sets.where("n > 0").select("doc_id", "n", "node", "t1"), labels)
    smallest = known.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    joined = known.join(smallest, "c")
    bare = sets.where("n = 0").withColumns(
        {"component_id": F.col("doc_id"), "c": F.lit(None).cast("bigint")}
    )
    if with_text_hash:
        columns += [F.col("t1").alias("text_hash"), F.col("c").alias("group")]
    return joined.select(*columns).unionByName(bare.select(*columns))
