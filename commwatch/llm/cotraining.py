"""Document quality by co-training of two views: the text's content and the page's metadata.

Each view has a logistic classifier of its own. Both start from the labelled documents. In each
round either names the unlabelled documents that it is most sure of, of both labels in their
proportion, and the other learns from these too. Then both are calibrated on labelled documents
that neither has learned from, and a last logistic model weighs the two.

The exchange covers all unlabelled documents, each distinct one once. Spark scores them in every
round, finds the logits of the surest share among all, and adds up the named ones by cells: equal
labels, language, source and size. The classifiers, fitted on the driver, see a cell as one row, the
mean of its documents with the weight of their number. So what a fit reads is bounded by the labelled
sample and the number of cells, and yet every named document counts.
"""

from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from commwatch.llm.arrow_text import chunks, flat, mix, word_hashes, words
from commwatch.llm.labelled import held_out, logistic, logistic_descent, sigmoid, training_rows
from commwatch.llm.storage import map_arrow, ship_package, stored

LABELLED = 6000  # the bound of the labelled sample
ROUNDS = 5
NAMED = 0.04  # share of the unlabelled documents left that a view names in a round
PSEUDO_WEIGHT = 0.5
CELLS = 256  # of named documents, for each view and label
SPREAD = 64  # first sums of a cell
FEWEST = 10  # unlabelled documents that a round needs
KEYS = 2_000_000  # labelled keys that are broadcast; more are shuffled
GRAMS = 1024  # hashed character trigrams
SOURCES, LANGS = 32, 16
KEPT = 0.5
MARKS = b"!?.,;:|#%$&*<>()[]{}-_/=\"'"


def _shares(data, owner, member, n):
    return np.bincount(owner[member], minlength=n)


def content_view(column):
    """Character trigrams, hashed and scaled to length one, and how varied the words are."""
    data, at = flat(column)
    n = len(column)
    owner = np.repeat(np.arange(n), np.diff(at))
    x = np.zeros((n, GRAMS + 3), np.float32)
    if len(data) > 2:
        code = (data[:-2].astype(np.uint64) << np.uint64(16)) | (
            data[1:-1].astype(np.uint64) << np.uint64(8)
        ) | data[2:]
        inside = owner[:-2] == owner[2:]
        bucket = (mix(code[inside]) & np.uint64(GRAMS - 1)).astype(np.int64)
        grams = np.bincount(owner[:-2][inside] * GRAMS + bucket, minlength=n * GRAMS)
        grams = np.log1p(grams.reshape(n, GRAMS))
        x[:, :GRAMS] = grams / np.maximum(np.linalg.norm(grams, axis=1), 1)[:, None]
    h, upto = word_hashes(data, at)
    text = np.repeat(np.arange(n), np.diff(upto))
    order = np.lexsort((h, text))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    total = np.maximum(np.diff(upto), 1)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    x[:, GRAMS] = np.bincount(text[order][fresh], minlength=n) / np.sqrt(total) / 10
    x[:, GRAMS + 1] = np.bincount(text[again], minlength=n) / total
    x[:, GRAMS + 2] = np.log1p(np.diff(upto)) / 10
    return x


def _hashed(column, size):
    """One column per bucket of a short text column; null has a bucket too."""
    data, at = flat(column)
    first, last, upto = words(data, at, lambda d: np.ones(len(d), bool))
    x = np.zeros((len(column), size), np.float32)
    h = np.zeros(len(column), np.int64)
    if len(first):
        whole, _ = word_hashes(data, at, inside=lambda d: np.ones(len(d), bool))
        h[np.flatnonzero(np.diff(upto))] = (whole % np.uint64(size - 1)).astype(np.int64) + 1
    x[np.arange(len(column)), h] = 1
    return x


def page_view(chunk):
    """Language, source, size and layout: lines, word and line lengths, shares of kinds of marks."""
    data, at = flat(chunk.column("text"))
    n = chunk.num_rows
    owner = np.repeat(np.arange(n), np.diff(at))
    size = np.maximum(np.diff(at), 1)
    first, last, upto = words(data, at)
    count = np.maximum(np.diff(upto), 1)
    lines, _, of = words(data, at, lambda d: d != 10)
    line_count = np.maximum(np.diff(of), 1)
    upper = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    mark = np.isin(data, list(MARKS))
    told = chunk.column("n_chars").fill_null(0).to_numpy(zero_copy_only=False).astype(float)
    plain = [
        np.log1p(np.maximum(told, 0)) / 10,
        np.log1p(size) / 10,
        np.log1p(line_count) / 5,
        np.log1p(count / line_count) / 5,
        size / count / 10,
        *(_shares(data, owner, m, n) / size for m in (upper, digit, mark, data >= 128, data == 10)),
        *(_shares(data, owner, data == c, n) / size * 4 for c in b"|!#%$&*"),
    ]
    layout = np.stack(plain, 1).astype(np.float32)
    return np.concatenate(
        [layout, _hashed(chunk.column("lang"), LANGS), _hashed(chunk.column("source"), SOURCES)], 1
    )


def _features(batches):
    """Both views of each row, and its cell; the first column is carried along."""
    for batch in batches:
        for chunk in chunks(batch):
            a = content_view(chunk.column("text")).astype(np.float16)
            b = page_view(chunk).astype(np.float16)
            lang, source = b[:, -SOURCES - LANGS : -SOURCES], b[:, -SOURCES:]
            size = np.frexp(np.diff(flat(chunk.column("text"))[1]))[1]
            kind = (lang.argmax(1) * SOURCES + source.argmax(1)) * 64 + size
            cell = mix(kind.astype(np.uint64)) & np.uint64(CELLS - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("k"),
                    pa.array(cell.astype(np.int32)),
                    pa.array([r.tobytes() for r in a], pa.binary()),
                    pa.array([r.tobytes() for r in b], pa.binary()),
                ],
                ["k", "cell", "a", "b"],
            )


FEATURES = "k long, cell int, a binary, b binary"


def _views(table):
    """The features of both views as arrays, of a batch or table with rows."""
    return [
        np.frombuffer(b"".join(table.column(c).to_pylist()), np.float16)
        .reshape(table.num_rows, -1)
        .astype(np.float32)
        for c in ("a", "b")
    ]


@dataclass
class Model:
    views: list = field(default_factory=list)  # of content and page: weights and bias
    scales: list = field(default_factory=list)  # calibration of each view: factor and offset
    mixing: tuple = (np.array([0.5, 0.5]), 0.0)

    def logits(self, a, b):
        raw = [x @ w + c for x, (w, c) in zip((a, b), self.views)]
        return np.stack([s * r + o for r, (s, o) in zip(raw, self.scales)], 1)

    def score(self, a, b):
        w, c = self.mixing
        return sigmoid(np.clip(self.logits(a, b), -8, 8) @ w + c)


@dataclass
class Turn:
    """A round's classifiers, and of each the logits up to and from which it names documents."""

    views: list
    limits: list

    def logits(self, x):
        return [v @ w + c for v, (w, c) in zip(x, self.views)]

    def named(self, x):
        """The label that either view gives each row, -1 where it is not sure."""
        return [
            np.where(logit >= high, 1, np.where(logit <= low, 0, -1))
            for logit, (low, high) in zip(self.logits(x), self.limits)
        ]


def _free(x, turns):
    """Rows that no view has named."""
    free = np.ones(len(x[0]), bool)
    for turn in turns:
        for named in turn.named(x):
            free &= named < 0
    return free


def _sums(x, cell, turns, now):
    """Number and sum of the rows that a view names now, by who learns of them, label and cell."""
    free = _free(x, turns)
    for k, named in enumerate(now.named(x)):
        at = np.flatnonzero(free & (named >= 0))
        if not len(at):
            continue
        key = ((1 - k) * 2 + named[at]) * (int(cell.max()) + 1) + cell[at]
        at = at[np.argsort(key, kind="stable")]
        first = np.flatnonzero(np.r_[True, np.diff(np.sort(key)) > 0])
        totals = np.add.reduceat(x[1 - k][at].astype(float), first, axis=0)
        for i, n, total in zip(at[first], np.diff(np.r_[first, len(at)]), totals):
            yield (1 - k, int(named[i]), int(cell[i])), int(n), total


def _added(parts):
    """Parts of ``(key, number, sum)`` added up by key."""
    found = {}
    for key, n, total in parts:
        before = found.get(key, (0, 0.0))
        found[key] = before[0] + n, before[1] + total
    return found


class Rows:
    """Unlabelled rows in memory, each a cell of its own."""

    def __init__(self, a, b):
        self.x, self.cell = [a, b], np.arange(len(a))

    def limits(self, turns, now, low, high):
        free = _free(self.x, turns)
        if free.sum() < FEWEST:
            return None
        logits = (logit[free] for logit in now.logits(self.x))
        return [np.quantile(x, [low, high], method="inverted_cdf") for x in logits]

    def told(self, turns, now):
        return _added(_sums(self.x, self.cell, turns, now))


def _free_logits(batches, turns, now):
    for batch in batches:
        if batch.num_rows:
            x = _views(batch)
            free = _free(x, turns)
            logits = [pa.array(logit[free].astype(float)) for logit in now.logits(x)]
            yield pa.RecordBatch.from_arrays(logits, ["a", "b"])


SUMS = "learner int, label int, cell int, n long, total binary"


def _sum_rows(found):
    rows = [(*key, n, np.asarray(total, float).tobytes()) for key, (n, total) in found.items()]
    kinds = [pa.int32()] * 3 + [pa.int64(), pa.binary()]
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SUMS.split(", ")])


def _parts(table):
    for r in table.select([c.split()[0] for c in SUMS.split(", ")]).to_pylist():
        yield (r["learner"], r["label"], r["cell"]), r["n"], np.frombuffer(r["total"])


def _named_sums(batches, turns, now):
    """A task's sums: one row per learner, label and cell."""
    found = {}
    for batch in batches:
        if batch.num_rows:
            cell = batch.column("cell").to_numpy()
            for key, n, total in _sums(_views(batch), cell, turns, now):
                before = found.get(key, (0, 0.0))
                found[key] = before[0] + n, before[1] + total
    yield _sum_rows(found)


def _add_up(table):
    return pa.Table.from_batches([_sum_rows(_added(_parts(table)))])


class Stored:
    """Unlabelled documents as a stored table of features; Spark scores and adds them up."""

    def __init__(self, table):
        self.table = table

    def limits(self, turns, now, low, high):
        run = partial(_free_logits, turns=turns, now=now)
        logits = map_arrow(self.table.select("a", "b"), run, "a double, b double")
        found = logits.agg(
            F.count("*"), *(F.percentile_approx(c, [low, high], 20_000) for c in ("a", "b"))
        ).first()
        return None if found[0] < FEWEST else found[1:]

    def told(self, turns, now):
        run = partial(_named_sums, turns=turns, now=now)
        ship_package(self.table.sparkSession)
        sums = map_arrow(self.table.select("cell", "a", "b"), run, SUMS)
        by = ["learner", "label", "cell"]
        part = (F.spark_partition_id() % SPREAD).alias("part")
        first = sums.select("*", part).groupBy(*by, "part").applyInArrow(_add_up, SUMS)
        return _added(_parts(first.groupBy(*by).applyInArrow(_add_up, SUMS).toArrow()))


def exchange(a, b, y, pool, rounds=ROUNDS):
    """A model from labelled rows of both views and a pool of unlabelled ones.

    What a round tells a view weighs at most as much as its share of the labelled rows would, so
    that the labels stay heard however large the pool is.
    """
    apart = np.arange(len(y)) % 4 == 3
    rate = float(y.mean())
    low, high = NAMED * (1 - rate), 1 - NAMED * rate
    given, turns = [[], []], []  # what each view was told by the other: rows, labels, weights
    fit = (logistic_descent, logistic)
    for turn in range(rounds + 1):
        views = []
        for k, x in enumerate((a, b)):
            told = [(x[~apart], y[~apart], np.ones((~apart).sum())), *given[k]]
            rows, answers, weights = (np.concatenate(t) for t in zip(*told))
            views.append(fit[k](rows.astype(np.float32 if k == 0 else float), answers, weights))
        now = Turn(views, [])
        limits = pool.limits(turns, now, low, high) if turn < rounds else None
        if limits is None:
            break
        # a view that finds all alike is sure of none
        now.limits = [(p, q) if p < q else (-np.inf, np.inf) for p, q in limits]
        found = sorted(pool.told(turns, now).items(), key=lambda item: item[0])
        for k in range(2):
            mine = [(key[1], n, total / n) for key, (n, total) in found if key[0] == k]
            if mine:
                answers, n, means = (np.array(t) for t in zip(*mine))
                weight = PSEUDO_WEIGHT * min(1.0, max(1.0, NAMED * len(y)) / n.sum())
                given[k].append((means, answers.astype(float), weight * n))
        turns.append(now)
    model = Model(views, [(1.0, 0.0)] * 2)
    raw = model.logits(a[apart], b[apart])
    scales = [logistic(raw[:, [k]], y[apart]) for k in range(2)]
    model.scales = [(float(w[0]), float(c)) for w, c in scales]
    model.mixing = logistic(np.clip(model.logits(a[apart], b[apart]), -8, 8), y[apart])
    return model


def co_train(a, b, y, pool_a, pool_b, rounds=ROUNDS):
    """A model from labelled and unlabelled rows of both views in memory."""
    return exchange(a, b, y, Rows(pool_a, pool_b), rounds)


COLUMNS = ["text", "lang", "source", "n_chars"]


def unlabelled_pool(docs, labels):
    """Features of all documents whose key has no label, equal documents once.

    The features, smaller than most texts, are shuffled once, after equal ones of a task have met.
    """
    keys = labels.select("doc_id").where("doc_id IS NOT NULL").distinct()
    few = keys.limit(KEYS + 1).count() <= KEYS
    rows = docs.select("doc_id", *COLUMNS).join(F.broadcast(keys) if few else keys, "doc_id", "left_anti")
    # nulls do not change a hash
    alike = F.xxhash64(*COLUMNS, *(F.col(c).isNull() for c in COLUMNS))
    found = map_arrow(rows.select(alike.alias("k"), *COLUMNS), _features, FEATURES)
    once = found.groupBy("k").agg(*(F.first(c).alias(c) for c in ("cell", "a", "b")))
    return Stored(stored(once, "features"))


def train(docs, labels, labelled=LABELLED):
    """A model from a bounded sample of labelled documents and all others; None if a label lacks.

    The sample has the rows with the smallest hashes of key and text, whatever the table's size, so
    a source counts by its share, and equal texts of a key count once. Labels of the held-out part
    are never read, and its labelled documents are not in the pool.
    """
    sample = training_rows(docs, labels, "quality", labelled, COLUMNS).orderBy("draw")
    rows = sample.select(F.col("label").cast("bigint").alias("k"), *COLUMNS)
    known = stored(map_arrow(rows, _features, FEATURES), "known").toArrow()
    y = known.column("k").to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    a, b = _views(known)
    return exchange(a, b, y.astype(float), unlabelled_pool(docs, labels))


def _score(batches, model):
    for batch in batches:
        for chunk in chunks(batch):
            if model is None:
                score = views = np.full((chunk.num_rows, 2), 0.5)
                score = score[:, 0]
            else:
                a, b = content_view(chunk.column("text")), page_view(chunk)
                score, views = model.score(a, b), sigmoid(model.logits(a, b))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("c_doc_id"), *(pa.array(np.asarray(x, float)) for x in (score, *views.T))],
                ["c_doc_id", "score", "content_score", "page_score"],
            )


def score_quality(docs, model):
    """One row per document: the joint score (higher is better) and those of the two views.

    Null texts count as empty, null metadata have a bucket of their own. Without a model every
    document scores one half. Repeated rows are scored one by one; an empty table gives no rows.
    Other columns are not read. One pass, no shuffle; the model is some kilobytes.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("c_doc_id"), "text", "lang", "source", "n_chars"
    )
    schema = "c_doc_id long, score double, content_score double, page_score double"
    scored = map_arrow(rows, partial(_score, model=model), schema)
    return scored.withColumnRenamed("c_doc_id", "doc_id")


def quality_scores(docs, labels):
    """Scores of all documents by a model trained on the labels outside the held-out part."""
    return score_quality(docs, train(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEPT).alias("kept"),
        "content_score",
        "page_score",
    )
