"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words and word beginnings, as abuse is inflected. Each scores the log-odds of occurring in
toxic against other texts, with Dirichlet priors in proportion to its share of the whole corpus; a
word scores the most that its tokens do. A token scores only if the texts that have it differ too, so
that one text full of a token proves nothing. A linear scan finds all disjoint segments of
maximal sum (Ruzzo and Tompa, 1999). Extreme-value statistics (Karlin and Altschul, 1990) tell which
of them chance alone would rarely give in a text of that length, and add up their evidence.
"""

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from commwatch.llm.arrow_text import (
    BASES, alphanumeric, chunks, flat, lower_ascii, signed, span_hashes, words,
)
from commwatch.llm.labelled import held_out, logistic, sigmoid, training_rows
from commwatch.llm.storage import map_arrow, stored

TRAIN_ROWS = 40_000  # labelled texts: the bound of the training sample
STEMS = (4, 5, 6, 7, 8)  # bytes of the word beginnings that are tokens beside whole words
LEAST_COUNT = 5  # toxic texts with the token
LEAST_ODDS = 1.0
LEAST_Z = 5.0  # standard deviations, by the likelihood ratio of a token's shares of texts
PRIOR = 500.0  # occurrences that the prior weighs
PASSAGE_ODDS = 0.1  # added cost of a token that tells nothing: passages stay short
MOST_E = 0.2  # expected number of chance segments as good, of a segment that counts
THRESHOLD = 0.3
RESULT = (
    "c_doc_id long, score double, max_segment double, n_segments int, "
    "segments array<struct<first:int,last:int,score:double,e_value:double>>"
)


def _tokens(column):
    """Hashes of each word's tokens, a row per word and 0 for none, and words before each text."""
    data, at = flat(column)
    data = lower_ascii(data)
    first, last, upto = words(data, at, alphanumeric)
    every = [span_hashes(data, first, last, BASES[0])]
    for stem in STEMS:
        h = np.zeros(len(first), np.uint64)
        longer = np.flatnonzero(last - first > stem)
        h[longer] = span_hashes(data, first[longer], first[longer] + stem, BASES[0])
        every.append(h)
    return np.stack(every, 1), upto


COUNTS = ("toxic", "other", "toxic_texts", "other_texts")


def _count(batches):
    """Per chunk and token, its occurrences in toxic and other labelled texts, and these texts."""
    for batch in batches:
        for chunk in chunks(batch):
            h, upto = _tokens(chunk.column("text"))
            owner = np.repeat(np.arange(chunk.num_rows), np.diff(upto) * h.shape[1])
            h = h.reshape(-1)
            owner, h = owner[h > 0], h[h > 0]
            order = np.lexsort((owner, h))
            h, owner = h[order], owner[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            toxic = chunk.column("label").to_numpy(zero_copy_only=False).astype(bool)[owner]
            values, place = np.unique(h, return_inverse=True)
            counts = [
                np.bincount(place, mask, len(values)).astype(np.int64)
                for mask in (toxic, ~toxic, toxic & fresh, ~toxic & fresh)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(values)), *map(pa.array, counts)], ["h", *COUNTS]
            )


class Lookup:
    """Places of hashes in a sorted array; most others are passed over by their last 16 bits."""

    def __init__(self, known):
        self.known = known
        self.marked = np.zeros(1 << 16, bool)
        self.marked[known & np.uint64(0xFFFF)] = True

    def __call__(self, h):
        """Indexes of the known ones in ``h``, flattened, and their places."""
        maybe = np.flatnonzero(self.marked[h & np.uint64(0xFFFF)])
        if not len(maybe):
            return maybe, maybe
        flat_h = h.reshape(-1)[maybe]
        place = np.minimum(np.searchsorted(self.known, flat_h), len(self.known) - 1)
        there = self.known[place] == flat_h
        return maybe[there], place[there]


def _shares(batches, known):
    """Per chunk, occurrences of each of some tokens, and of all tokens under the number -1."""
    lookup = Lookup(known)
    for batch in batches:
        for chunk in chunks(batch):
            h, _ = _tokens(chunk.column("text"))
            counts = np.bincount(lookup(h)[1], minlength=max(1, len(known)))
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(seen, -1)), pa.array(np.append(counts[seen], np.count_nonzero(h)))],
                ["token", "n"],
            )


@dataclass
class Model:
    known: np.ndarray  # hashes of the tokens that score above zero, ascending
    scores: np.ndarray
    rest: float  # the score of any other token
    decay: float  # lambda of the extreme-value law
    space: float  # K of that law
    weights: tuple = (1.0, 0.0)  # of the evidence and of the logarithm of the text's tokens
    bias: float = -4.0  # until there are labels to learn from, no text counts as toxic


def decay_of(scores, shares, rest):
    """The positive root of the mean of exp(decay * score) = 1 under the background's shares."""
    s = np.append(scores, rest)
    p = np.append(shares, 1 - shares.sum())
    low, high = 1e-6, 1.0
    value = lambda x: (p * np.exp(np.minimum(x * s, 700))).sum() - 1
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def segments(places, scores, rest):
    """All maximal scoring segments as ``(first, last, sum)``, given the places that score above zero.

    Places between them score ``rest`` each. The algorithm of Ruzzo and Tompa: candidates are kept
    on a stack with the sums before and after them and a link to the nearest one that began lower, so
    each is passed or merged a bounded number of times and the scan is linear.
    """
    found = []  # (sum before, sum after, first, last, nearest candidate that began lower)
    total, at = 0.0, -1
    for place, score in zip(places, scores):
        total += rest * (place - at - 1)
        left, first, at = total, place, place
        total = right = left + score
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            if j < 0 or found[j][1] >= right:
                found.append((left, right, first, place, j))
                break
            left, _, first, _, lower = found[j]
            del found[j:]
            j = lower
    return [(a, b, right - left) for left, right, a, b, _ in found]


def judge(places, scores, n, model):
    """Significant segments of a text of n tokens, and the evidence that they add up to."""
    found = []
    for first, last, total in segments(places, scores, model.rest):
        e = model.space * n * np.exp(-model.decay * total)
        if e <= MOST_E:
            found.append((first, last, total, float(e)))
    return found, float(np.log1p(sum(-np.log(max(e, 1e-300)) for *_, e in found)))


def _score(batches, model, features_only):
    lookup = Lookup(model.known)
    for batch in batches:
        for chunk in chunks(batch):
            h, upto = _tokens(chunk.column("text"))
            index, place = lookup(h)
            word_score = np.zeros(len(h))
            np.maximum.at(word_score, index // h.shape[1], model.scores[place])
            hits = np.flatnonzero(word_score)
            edges = np.searchsorted(hits, upto)
            rows, best, evidence = [], [], []
            for k in range(chunk.num_rows):
                mine = hits[edges[k] : edges[k + 1]]
                found, sum_ = judge(
                    (mine - upto[k]).tolist(), word_score[mine].tolist(),
                    int(upto[k + 1] - upto[k]), model,
                )
                rows.append([dict(zip(("first", "last", "score", "e_value"), f)) for f in found])
                best.append(max((f[2] for f in found), default=0.0))
                evidence.append(sum_)
            length = np.log1p(np.diff(upto))
            if features_only:
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("label"), pa.array(evidence, pa.float64()), pa.array(length)],
                    ["label", "x", "length"],
                )
                continue
            by_x, by_length = model.weights
            score = sigmoid(by_x * np.array(evidence) + by_length * length + model.bias)
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()),
                                       ("score", pa.float64()), ("e_value", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("c_doc_id"), pa.array(score), pa.array(best, pa.float64()),
                 pa.array([len(r) for r in rows], pa.int32()), pa.array(rows, kind)],
                ["c_doc_id", "score", "max_segment", "n_segments", "segments"],
            )


def _z(one, of_one, other, of_other):
    """Signed root of the likelihood ratio: a token's share of the texts of each label, against one share.

    Of tokens in as many texts of the one label, that in fewest others has the highest value.
    """

    def likelihood(x, n):
        parts = (x, n - x)
        return sum(p * np.log(np.maximum(p, 1) / max(n, 1)) for p in parts)

    apart = likelihood(one, of_one) + likelihood(other, of_other)
    ratio = 2 * (apart - likelihood(one + other, of_one + of_other))
    return np.sign(one * of_other - other * of_one) * np.sqrt(np.maximum(ratio, 0))


def train(docs, labels, most=TRAIN_ROWS):
    """A model learned from at most ``most`` labelled texts, with priors from all of ``docs``.

    Labels of the held-out part are never read. A table without toxic labels gives a model that
    finds nothing and scores every text alike.
    """
    texts = training_rows(docs, labels, "toxic", most, ["text"])
    # copies of a text are evidence once
    once = texts.groupBy(F.xxhash64("text")).agg(F.max("label").alias("label"), F.first("text").alias("text"))
    texts = stored(once.select("text", "label"), "labelled")
    counts = stored(
        map_arrow(texts, _count, "h long, " + ", ".join(f"{c} long" for c in COUNTS))
        .groupBy("h")
        .agg(*(F.sum(c).alias(c) for c in COUNTS)),
        "counts",
    )
    total = counts.agg(F.sum("toxic"), F.sum("other")).first()
    n1, n0 = (float(x or 0) for x in total)
    of = dict(texts.groupBy("label").count().collect())
    t1, t0 = of.get(1, 0), of.get(0, 0)
    # bounded: each of these tokens takes LEAST_COUNT of the sample's toxic texts
    chosen = counts.where(F.col("toxic_texts") >= LEAST_COUNT).orderBy("h").toArrow()
    known = chosen.column("h").to_numpy().view(np.uint64)
    order = np.argsort(known)
    known = known[order]
    y1, y0, d1, d0 = (chosen.column(c).to_numpy()[order].astype(float) for c in COUNTS)
    z = _z(d1, t1, d0, t0)
    known, y1, y0 = known[z >= LEAST_Z], y1[z >= LEAST_Z], y0[z >= LEAST_Z]
    run = partial(_shares, known=known)
    shares = map_arrow(docs.select("text"), run, "token long, n long").groupBy("token").agg(
        F.sum("n").alias("n")
    )
    seen = dict(shares.toArrow().to_pandas().itertuples(index=False))
    share = np.array([seen.get(k, 0) for k in range(len(known))]) / max(1, seen.get(-1, 1))
    a = PRIOR * np.maximum(share, 1e-12)
    odds = np.log((y1 + a) / (n1 + PRIOR - y1 - a)) - np.log((y0 + a) / (n0 + PRIOR - y0 - a))
    pick = odds > LEAST_ODDS
    known, scores = known[pick], odds[pick]
    left1, left0 = n1 - y1[pick].sum(), n0 - y0[pick].sum()
    rest = np.log((left1 + 1) / (n1 + PRIOR)) - np.log((left0 + 1) / (n0 + PRIOR))
    rest = min(float(rest), 0.0) - PASSAGE_ODDS
    background = (y0[pick] + a[pick]) / (n0 + PRIOR)
    decay = decay_of(scores, background, rest) if len(known) else 1.0
    # K: no more than the background's chance of a scoring token, where alone a segment can begin
    space = max(float(background.sum()), 1 / (n0 + PRIOR))
    model = Model(known, scores, rest, decay, space)
    seen_by = partial(_score, model=model, features_only=True)
    table = map_arrow(texts, seen_by, "label int, x double, length double").toArrow()
    y = table.column("label").to_numpy().astype(float)
    if len(y):
        x = np.column_stack([table.column(c).to_numpy() for c in ("x", "length")])
        w, b = logistic(x, y)
        model.weights, model.bias = (max(0.0, float(w[0])), float(w[1])), float(b)
    return model


def score_toxicity(docs, model):
    """One row per document: its score, its significant segments and the best of these.

    ``segments`` gives first and last token (runs of letters and digits, from 0), the sum of
    log-odds and the expected number of chance segments as good. The score depends on the text
    alone and lies between 0 and 1. Null and empty texts have no segments and the score of a text
    without any. Repeated rows are scored one by one; an empty table gives no rows. Other columns
    are not read. One pass, no shuffle; the model holds the scoring tokens only.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("c_doc_id"), "text")
    scored = map_arrow(rows, partial(_score, model=model, features_only=False), RESULT)
    return scored.withColumnRenamed("c_doc_id", "doc_id")


def toxicity_report(docs, labels):
    """Scores of all documents by a model trained on the labels outside the held-out part."""
    scored = score_toxicity(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "max_segment",
        "n_segments",
    )
