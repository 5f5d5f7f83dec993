import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from commwatch.llm.spelling import _codes, document_words, groups_for, near_pairs, spelling_groups

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_words(rows, damage=97, shortest=5, rarest=3):
    n = Counter()
    for key, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= rarest}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(n, factor=2):
    gaps, masks = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            gaps[w[:k] + w[k + 1 :]].add(w)
            masks[w[:k], w[k + 1 :]].add(w)
    found = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            found[w] |= masks[w[:k], w[k + 1 :]] - {w}
        for longer in gaps[w]:
            found[w].add(longer)
            found[longer].add(w)
    form = {}
    for w in n:
        best = min(found[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, repr(form[w]), root(w), n[w], len(found[w]), repr(n.get(form[w]))) for w in n)


def rows_of(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, repr(r.form), r.root, r.n, r.n_near, repr(r.form_n)) for r in frame.collect())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("longer", [0, 1])
def test_near_pairs_by_brute_force(seed, longer):
    draw = random.Random(seed)
    left = sorted({"".join(draw.choice("abcé") for _ in range(5)) for _ in range(200)})
    right = sorted({"".join(draw.choice("abcé") for _ in range(5 + longer)) for _ in range(200)})
    a, b = (_codes("".join(w)).reshape(len(w), -1) for w in (left, right))
    i, j = near_pairs(a, b)
    want = {(x, y) for x, p in enumerate(left) for y, q in enumerate(right) if near(p, q)}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
    i, j = near_pairs(a, a, itself=True)
    assert np.all(i < j) and len(i) == sum(near(p, q) for p in left for q in left) / 2


@pytest.mark.parametrize("block_words", [3, 1024])
def test_groups_by_brute_force(spark, block_words):
    draw = random.Random(4)
    n = {"".join(draw.choice("abcdeß日") for _ in range(draw.randrange(1, 6))): draw.randrange(1, 40) for _ in range(700)}
    n |= {"abcde" * 800: 9, "abcde" * 800 + "f": 2, "solitary": 5, "": 4}
    # words of one length and letters, of which many make a hot block
    n |= {"".join(draw.sample("abcdefgh", 8)): draw.randrange(1, 9) for _ in range(300)}
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    clashing = words.withColumns({"root": F.lit("x"), "block": F.lit(1), "key": F.lit(2)})
    assert rows_of(spelling_groups(clashing, block_words=block_words)) == plain_groups(n)


def test_chains_of_forms(spark):
    """Each word has its successor as a form, so the root is many steps away."""
    chain = {"a" * (40 - k) + "b" * k: 3**k for k in range(20)}
    words = spark.createDataFrame(list(chain.items()), "word string, n long")
    got = {r.word: r.root for r in spelling_groups(words).collect()}
    assert set(got.values()) == {"a" * 21 + "b" * 19}


def test_repeated_null_and_tied_words(spark):
    rows = [("colour", 2), ("colour", 4), ("color", 6), (None, 3), ("colours", None), ("colors", 3), ("dolor", 6)]
    words = spark.createDataFrame(rows, "word string, n long")
    n = {"colour": 6, "color": 6, "colours": 0, "colors": 3, "dolor": 6}
    assert rows_of(spelling_groups(words)) == plain_groups(n)


def test_words_of_documents(odd, odd_rows):
    for limits in ({"shortest": 5, "rarest": 3}, {"shortest": 1, "rarest": 1}):
        got = {r.word: r.n for r in document_words(odd, damage=97, **limits).collect()}
        assert got == plain_words([r[:2] for r in odd_rows], **limits)


def test_letters_end_with_their_text(spark):
    docs = spark.createDataFrame([(1, "Straße ÀÉ×÷"), (2, "éa1b_c"), (3, "日本éé")], "doc_id long, text string")
    got = {r.word: r.n for r in document_words(docs, shortest=1, rarest=1).collect()}
    assert got == {"straße": 1, "ÀÉ×÷": 1, "éa": 1, "b": 1, "c": 1, "éé": 1}


def test_query_by_brute_force(spark, sf_dir):
    from commwatch.llm.queries import op12_spelling_variants

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(op12_spelling_variants(spark, sf_dir)) == plain_groups(plain_words(docs))


def test_more_words_take_more_groups():
    assert [groups_for(n) for n in (0, 10_000, 100_000, 10**6, 10**12)] == [3, 3, 4, 6, 8]


def test_empty_table(spark, none):
    assert spelling_groups(document_words(none, damage=97)).count() == 0
