import itertools
import random
import re

import numpy as np
import pytest

from commwatch.llm.decontamination import MASKS, benchmark_hits
from tests.llm.conftest import prose

ITEM = "doc_id long, text string"


def find(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, ITEM)
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in benchmark_hits(docs, items, **options).collect()}


def replaced(text, every):
    return " ".join("other" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def test_whole_passages_and_passages_with_replaced_words(spark):
    items = [(i, prose(100 + i, 30 + i, 5000)) for i in range(12)]
    docs = []
    for i, text in items:
        around = prose(200 + i, 150, 5000), prose(300 + i, 90, 5000)
        for kind, middle in enumerate((text, replaced(text, 4), replaced(text, 5), text.upper() + "!")):
            docs.append((10 * i + kind, f"{around[0]} {middle} {around[1]}"))
        docs.append((10 * i + 7, " ".join(around)))
    got = find(spark, docs, items)
    assert set(got) == {(10 * i + k, i) for i, _ in items for k in range(4)}
    whole = got[(0, 0)]
    assert (whole.from_word, whole.to_word, whole.matched, whole.item_words) == (150, 179, 30, 30)


def test_random_replacements_are_nearly_all_found(spark):
    draw = random.Random(5)
    items = [(i, prose(400 + i, 40, 5000)) for i in range(60)]
    docs = [
        (i, " ".join("other" if draw.random() < 0.15 else w for w in text.split()))
        for i, text in items
    ]
    assert len(find(spark, docs, items)) >= 58


def test_half_an_item_and_overhanging_ends(spark):
    item = prose(7, 40, 5000)
    words = item.split()
    docs = [(1, " ".join(words[20:]) + " then more"), (2, "start " + " ".join(words[:20])), (3, " ".join(words[:9]))]
    got = find(spark, docs, [(5, item)])
    assert set(got) == {(1, 5), (2, 5)} and got[(1, 5)].shift == -20 and got[(1, 5)].from_word == 0


@pytest.mark.parametrize("words", range(13, 26))
def test_every_pattern_of_the_rule_holds_a_seed(words):
    replaced = words - -(-7 * words // 10)
    patterns = np.fromiter(
        (sum(1 << i for i in places) for places in itertools.combinations(range(words), replaced)),
        np.int64,
    )
    patterns = ((1 << words) - 1) & ~patterns
    seeded = np.zeros(len(patterns), bool)
    for mask in MASKS:
        bits = int(mask[::-1], 2)
        for at in range(words - len(mask) + 1):
            seeded |= (patterns & (bits << at)) == bits << at
    assert seeded.all()


def plain_hits(text, item):
    """First and last equal word in the text and their number, by shift, from all windows."""
    text, item = (re.findall(r"[^\W_]+", t.lower()) for t in (text, item))
    found = {}
    for shift in range(-len(item) + 1, len(text)):
        equal = [0 <= i + shift < len(text) and text[i + shift] == w for i, w in enumerate(item)]
        if sum(equal) < min(10, len(item)):
            continue
        if len(item) < 13:
            inside = set(range(len(item))) if all(equal) else set()
        else:
            # windows may hang over the ends of the item too; words there count as replaced
            equal = [False] * 12 + equal + [False] * 12
            inside = {
                k - 12
                for n in range(13, 26)
                for a in range(len(equal) - n + 1)
                if 10 * sum(equal[a : a + n]) >= 7 * n
                for k in range(a, a + n)
                if equal[k]
            }
        if inside:
            found[shift] = (shift + min(inside), shift + max(inside), len(inside))
    return found


def test_same_hits_as_all_windows_of_all_pairs(spark):
    draw = random.Random(11)
    items, docs = [], []
    for i, n in enumerate([1, 2, 3, 5, 6, 7, 9, 12, 13, 14, 17, 25, 26, 40, 63, 64, 65, 130, 200]):
        item = prose(700 + i, n, 300).split()
        items.append((i, " ".join(item)))
        for copy in range(6):
            rate = (0, 0.1, 0.2, 0.25, 0.3, 0.35)[copy]
            cut = item[draw.randrange(max(1, n // 3)) :] if copy % 2 else item
            edited = ["other" if draw.random() < rate else w for w in cut]
            around = prose(10 * i + copy, draw.choice((0, 0, 4, 40)), 300)
            docs.append((100 * i + copy, " ".join([around, *edited, prose(i, draw.choice((0, 30)), 300)])))
    expected = {
        (d, i, shift): hit
        for d, text in docs for i, item in items for shift, hit in plain_hits(text, item).items()
    }
    rows = benchmark_hits(
        spark.createDataFrame(docs, ITEM), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got = {(r.doc_id, r.item_id, r.shift): (r.from_word, r.to_word, r.matched) for r in rows}
    assert len(got) == len(rows) and got == expected and len(got) > 80


def test_an_item_as_long_as_a_book(spark):
    item = prose(21, 20_000, 60_000)
    words = item.split()
    docs = [(1, item), (2, "some words " + " ".join(words[9_000:9_040])), (3, prose(22, 500, 60_000))]
    got = find(spark, docs, [(1, item)])
    assert set(got) == {(1, 1), (2, 1)}
    assert got[(1, 1)].matched == 20_000 and got[(2, 1)].shift == 2 - 9_000


def test_blocks_of_seeds_give_the_same_hits(spark):
    items = [(i, prose(500 + i, 25, 5000)) for i in range(10)]
    docs = [(i, f"{prose(i, 50)} {text}") for i, text in items]
    assert set(find(spark, docs, items)) == set(find(spark, docs, items, block_seeds=100))


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(1, prose(1, 120)), (2, None), (3, ""), (4, "too few"), (1, prose(1, 120)), (None, prose(2, 60))],
        "item_id long, text string",
    )
    got = benchmark_hits(odd, items).select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in got} == {(1, 1), (2, 1), (11, 1), (3, None), (None, None), (11, None)}
    assert benchmark_hits(none, items).count() == 0
    assert benchmark_hits(odd, items.limit(0)).count() == 0
