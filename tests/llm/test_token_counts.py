import random

import pytest
from tokenizers import Tokenizer

from commwatch.llm import token_counts
from commwatch.llm.queries import byte_vocabulary
from commwatch.llm.token_counts import codec, count_tokens, spliced_count


def vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def hard_texts():
    """Texts that a cut can break: contractions, runs of one kind, special strings, marks."""
    draw = random.Random(11)
    yield "hello we'll go " * 120
    yield "a" * 2500
    yield "".join(draw.choice("abcdefghij") for _ in range(3000))
    yield "日本語テキスト、長い文。" * 90
    yield "กขฃคฅฆงจฉชซ" * 150
    yield " " * 1500 + "x" + "\n" * 500 + " \t" * 300
    yield "<|endoftext|>" * 90 + "x" * 300 + "<|endoftext|>" + "'s" * 300
    yield "!?" * 100 + "<" * 700 + "|" + ">" * 300 + "'" * 700 + "ll"
    yield "".join(draw.choice("日本ab ́e‍😀'") for _ in range(2500))
    for _ in range(12):
        letters = draw.sample("abc de'\"lt s\n.1234,日本é̀<|endoftext|>", 8)
        yield "".join(draw.choice(letters) for _ in range(draw.randrange(200, 2500)))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"])
def test_spliced_counts_are_those_of_whole_texts(name):
    by = codec(vocabulary(name))
    for text in hard_texts():
        whole = by.counts([text])[0]
        for chunk, overlap in ((100, 8), (150, 40), (700, 64)):
            assert spliced_count(text, by, chunk, overlap) == whole, text[:40]


def test_overlaps_widen_where_nothing_aligns(monkeypatch):
    """An encoder that cuts every text differently never aligns, so the whole text is encoded."""
    by = codec(vocabulary("byte_bpe_50k.json"))
    asked = []
    monkeypatch.setattr(by, "meet", lambda text, left, right, low, high: asked.append(high - low))
    text = "some words " * 100
    assert spliced_count(text, by, 200, 16) == by.counts([text])[0]
    assert {16, 32, 64, 128} <= set(asked) and max(asked) > 200


def test_memory_is_bounded_by_chunks(monkeypatch):
    by = codec(vocabulary("byte_bpe_50k.json"))
    sizes, encode = [], by.encode
    monkeypatch.setattr(by, "encode", lambda t, offset: sizes.append(len(t)) or encode(t, offset))
    text = "we'll see 12 words, " * 2000
    assert spliced_count(text, by, 1000, 64) == by.counts([text])[0]
    assert max(sizes) <= 1064 and len(sizes) == 40


def plain(rows):
    library = Tokenizer.from_file(byte_vocabulary())
    for row in rows:
        text = row[1] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        yield row[0], len(text.encode()), n, n > 512


def test_counts_as_the_library(odd, odd_rows):
    for chunk in (token_counts.CHUNK, 300):
        got = count_tokens(odd, byte_vocabulary(), chunk=chunk, overlap=32)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(odd_rows)))


def test_query_as_the_library(spark, sf_dir):
    from commwatch.llm.queries import op11_token_counts

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op11_token_counts(spark, sf_dir).collect())) == sorted(plain(rows))


def test_empty_table(none):
    assert count_tokens(none, byte_vocabulary()).count() == 0
