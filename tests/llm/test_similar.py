import random
from collections import Counter, defaultdict

from commwatch.llm.components import components
from commwatch.llm.ngram_jaccard import similar_components
from commwatch.llm.substring_dedup import COVER, EMPTY_SHA, PERIOD, remove_repeats
from tests.llm.conftest import prose

DOC = "doc_id long, text string"
LOWEST = -(2**63)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = lower(text).encode().split()
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def plain_components(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    parent, seen = list(range(len(sets))), defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, s) in enumerate(sets):
        shared = Counter(j for e in s for j in seen[e])
        for e in s:
            seen[e].append(i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            smallest[root(i)] = min(smallest.get(root(i), k), k)
    return Counter(
        (k, len(s), smallest.get(root(i)) if s else k) for i, (k, s) in enumerate(sets)
    )


def edited(draw, base, times):
    words = list(base)
    for _ in range(times):
        p, kind = draw.randrange(len(words)), draw.random()
        if kind < 0.4:
            words[p] = f"v{draw.randrange(50)}"
        elif kind < 0.7:
            words.insert(p, f"v{draw.randrange(50)}")
        elif len(words) > 1:
            del words[p]
    return " ".join(words)


def families(seed, sizes, copies):
    draw, rows = random.Random(seed), []
    for n in sizes:
        base = [f"w{draw.randrange(300)}" for _ in range(n)]
        for _ in range(copies):
            rows.append((len(rows), edited(draw, base, draw.choice([0, 0, 1, 2, 3, max(1, n // 25)]))))
    return rows


def check(spark, rows):
    got = similar_components(spark.createDataFrame(rows, DOC)).collect()
    assert Counter(map(tuple, got)) == plain_components(rows)


def test_components_of_families_of_all_sizes(spark):
    check(spark, families(4, [1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 100, 130, 255, 300] * 3, 6))


def test_texts_that_share_a_long_passage(spark):
    passage = prose(9, 60, 300)
    rows = [(i, f"{passage} {prose(1000 + i, 20 + i % 60, 5000)}") for i in range(150)]
    check(spark, rows + [(200 + i, t + " end") for i, (_, t) in enumerate(rows[:20])])


def test_large_group_of_near_copies_with_chains(spark):
    draw = random.Random(6)
    words, rows = prose(11, 200, 5000).split(), []
    for i in range(120):  # drifts away from its first form step by step
        words[draw.randrange(200)] = f"new{i}"
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_components_of_odd_rows(odd, odd_rows, none):
    got = similar_components(odd).collect()
    assert Counter(map(tuple, got)) == plain_components([r[:2] for r in odd_rows])
    assert similar_components(none).count() == 0


def test_component_labels(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 105), (105, 103), (7, 7), (100, 105), (200, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(1, 61)} == {1} and got[103] == got[105] == 100 and got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_removal(rows, window=20):
    import hashlib

    rows = [(k, LOWEST if k is None else k, (t or "").encode().split()) for k, t in rows]
    first = {}
    for _, k, w in rows:
        for i in range(len(w) - window + 1):
            seq = tuple(w[i : i + window])
            first[seq] = min(first.get(seq, (k, i)), (k, i))
    out = []
    for key, k, w in rows:
        gone = set()
        for i in range(len(w) - window + 1):
            if (k, i) > first[tuple(w[i : i + window])]:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_cover_holds_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_repeats_at_every_distance_and_length(spark):
    passage, rows = prose(21, 40, 9000).split(), []
    for i, length in enumerate([19, 20, 21, 25, 40] * 8):
        begin = i % (41 - length)
        rows.append((100 - i, f"{prose(i, i, 9000)} {' '.join(passage[begin : begin + length])} {prose(50 + i, 30, 9000)}"))
    rows.append((500, " ".join(["again"] * 70)))  # a document that repeats itself
    rows.append((501, " ".join([prose(77, 25, 9000)] * 3)))
    got = remove_repeats(spark.createDataFrame(rows, DOC)).collect()
    assert Counter(map(tuple, got)) == plain_removal(rows)


def test_removal_of_odd_rows(odd, odd_rows, none):
    got = remove_repeats(odd, with_text=True).collect()
    assert Counter(tuple(r)[:4] for r in got) == plain_removal([r[:2] for r in odd_rows])
    assert all((r.kept == "") == (r.kept_sha256 == EMPTY_SHA) for r in got)
    assert remove_repeats(none).count() == 0
