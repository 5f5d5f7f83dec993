import re
from collections import Counter

from commwatch.llm.quality_rules import judge_quality, quality_report


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


CASES = [
    "a b c a b c", "x x x x x", "a\nb\na\n\n \n", "# $ | word\x0bnext\x0c end\r\n", "ä ö 𝒳 ß",
    "one two three four one two three five one two", "\n", "a b c d e f g a b c",
]


def test_counts_are_those_of_the_plain_version(spark, odd, odd_rows, none):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    for r in quality_report(df).collect():
        assert tuple(r)[1:6] == counts(CASES[r.doc_id]), CASES[r.doc_id]
    got = Counter(tuple(r)[:6] for r in quality_report(odd).collect())
    assert got == Counter((k, *counts(t)) for k, t, *_ in odd_rows)
    assert quality_report(none).count() == 0


def test_verdicts(spark):
    clean = " ".join(f"the word{i} of text{i} and so{i} on" for i in range(15))
    rows = [
        (1, clean), (2, clean.replace(" ", " %%% ")), (3, "the end " * 60), (4, "too short"),
        (5, None), (6, " ".join(f"zzz{i}" for i in range(80))), (7, (clean + "\n") * 1 + "a\n" * 30),
    ]
    got = {r.doc_id: r for r in quality_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k for k, r in got.items() if r.kept} == {1}
    assert {k for k, r in got.items() if r.base_failed} >= {3, 4, 5}
    assert got[2].failed == "symbol_ratio > 0.1" and got[6].failed == "stop_word_ratio < 0.02"
    assert got[7].failed == "dup_line_ratio > 0.4"


def test_one_projection_without_user_functions(odd):
    plan = judge_quality(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
