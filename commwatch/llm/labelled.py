"""Labels that may be learned from, and a logistic fit."""

import numpy as np
from pyspark.sql import functions as F

from commwatch.llm.storage import stored

HELD_OUT = 2  # of the remainders of a key's checksum by four


def held_out(key):
    """Rows kept apart from learning, by the checksum of the key as text. Null keys are learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def smallest(df, draw, most):
    """The ``most`` rows of ``df`` with the smallest ``draw``, a column of uniform 64-bit numbers.

    A threshold found from the count of rows leaves little more than these to be sorted; otherwise
    every partition would send ``most`` rows to the one task that sorts. Where the numbers are not
    uniform and too few lie below the threshold, all rows are sorted.
    """
    n = df.count()
    wanted = most + 6 * most**0.5 + 10
    if n > 2 * wanted:
        near = df.where(F.col(draw) <= int(2**64 * (wanted / n)) - 2**63)
        df = near if near.count() >= most else df
    return df.orderBy(draw).limit(most)


def training_labels(labels, column, most):
    """``(doc_id, label)`` of at most ``most`` labelled rows outside the held-out part.

    The rows with the smallest hashes of their keys, whatever the table's size. Rows without a key
    or label are passed over; of differing labels of a key the larger counts.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    usable = usable.where(~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))
    drawn = stored(one.withColumn("draw", F.xxhash64("doc_id")), "labels")
    return stored(smallest(drawn, "draw", most).drop("draw"), "labels")


def training_rows(docs, labels, column, most, columns):
    """``label``, ``draw`` and the columns of at most ``most`` labelled documents, ``text`` among them.

    The documents of the labels of ``training_labels``, equal texts of a key once. Keys are bounded
    before the join; a key may have any number of texts, so the rows are bounded once more after it,
    by narrow rows, before any text is moved.
    """
    keys = training_labels(labels, column, most)
    key = ["doc_id", "draw"]
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("draw"), *columns)
    joined = rows.join(F.broadcast(keys), "doc_id")
    drawn = stored(joined.select(*key).distinct(), "drawn")
    picked = stored(smallest(drawn, "draw", most), "sample")
    once = joined.join(F.broadcast(picked), key).groupBy(*key)
    # one whole row of those that share key and text
    first = once.agg(F.min(F.struct("label", *columns)).alias("row"))
    return first.select("draw", "row.*")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logistic(x, y, weight=None, ridge=1.0, rounds=60):
    """Weights and bias of a ridge-regularised logistic model, by Newton's method.

    For many columns use ``logistic_descent``.
    """
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + keep * w
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], w[-1]


def logistic_descent(x, y, weight=None, ridge=1e-4, rounds=250, rate=0.05):
    """The same model by Adam on all rows, for many columns."""
    weight = np.ones(len(x), np.float32) if weight is None else weight.astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    total = weight.sum()
    for t in range(1, rounds + 1):
        error = weight * (sigmoid(x @ w + b) - y).astype(np.float32) / total
        g, gb = x.T @ error + ridge * w, float(error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, c = 1 - 0.9**t, 1 - 0.999**t
        w -= rate * (m / a) / (np.sqrt(v / c) + 1e-8)
        b -= rate * (mb / a) / (np.sqrt(vb / c) + 1e-8)
    return w, b
