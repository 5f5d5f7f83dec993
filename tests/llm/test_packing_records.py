import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from commwatch.llm import encoding
from commwatch.llm.checksums import crc32c, masked
from commwatch.llm.packing import pack, pack_documents, step_groups
from commwatch.llm.records import RecordError, frames, payloads_of, read_some, token_records, write_records

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
VOCABULARY = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encode():
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    return lambda text: library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_cache_gives_the_ids_of_running_text(encode):
    from commwatch.llm.encoding import encoder

    codec = encoder(VOCABULARY)
    texts = [
        "", " ", "  ", " a  b   c\n\n d ", "x\ty", "don 't it's <|endoftext|> ok", " lead", "trail ",
        "日本語 テキスト 1234 12,5. a.b. ,", "\n\n x \r\n y", "É,É. ß. ŉa", "a" * 3000, "naïve… “q” a—b",
        "a b 　c", "x\x1cy \x85 z", "1st 2nd, (3rd). [x] {y}", "A.b,C. D", "ſ K İ ı",
    ]
    for text in texts:
        got = np.frombuffer(codec.encode(text), codec.dtype).tolist()
        assert got == encode(text), text


def test_lines_are_cut_like_whole_texts(encode, monkeypatch):
    """Line breaks alone, in pairs, at either end, beside spaces and special strings."""
    monkeypatch.setattr(encoding, "MOST_PIECES", 20)
    codec = encoding.Encoder(VOCABULARY)
    texts = [
        "a b\n", "b\nc d", "\na", "\n", "\n\n", "\n\na", "b\n\nc d", "b\n\n", "b\n\n\nc", "x\n\n\n\ny",
        "a\n <|endoftext|>", "a\n\n<|endoftext|>", "a\n\n<|endoftext|>\n\nb", "a<|endoftext|>\nb", "b c\n d",
        "we'll\n's it's\n\n'd", "é\nß 日本\n\n語", "a\tb\nc", "1\n2\n\n3 4\n,\n.", "\u3000\nx", " \n", "\n ",
    ]
    draw = random.Random(3)
    texts += ["".join(draw.choice("ab \n.1") for _ in range(40)) for _ in range(300)]
    for text in texts * 2:
        assert np.frombuffer(codec.encode(text), codec.dtype).tolist() == encode(text), repr(text)


def test_long_pieces_do_not_stay_in_memory(encode):
    codec = encoding.Encoder(VOCABULARY)
    for k in range(20):
        text = f"{k} " + chr(0x4E00 + k) * 2000 + f" {k}"
        assert np.frombuffer(codec.encode(text), codec.dtype).tolist() == encode(text)
    kept = [*codec.firsts.items(), *codec.others.items()]
    assert sum(4 * len(piece) + len(ids) for piece, ids in kept) < 10_000


def test_packing_places_every_id_once_without_padding():
    draw = random.Random(3)
    lengths = [draw.choice([1, 2, 7, 300, 513, 2047, 2048, 2049, 9000]) for _ in range(800)]
    found = defaultdict(list)
    for tier, pieces in pack(lengths):
        total = sum(n for _, _, n in pieces)
        assert total == tier and tier & (tier - 1) == 0 and tier <= 2048
        for d, start, n in pieces:
            found[d].append((start, n))
    for d, pieces in found.items():
        at = 0
        for start, n in sorted(pieces):
            assert start == at
            at += n
        assert at == lengths[d]
    assert len(found) == len(lengths) and list(pack([])) == []


def test_step_groups_cost_about_the_same():
    sequences = list(pack([500 + 13 * i % 1500 for i in range(2000)]))
    chosen, count = step_groups(sequences)
    cost = [0] * count
    for g, (_, pieces) in zip(chosen, sequences):
        cost[g] += sum(n * (1 + n / 4096) for _, _, n in pieces)
    assert count > 5 and max(cost) < 1.05 * min(cost)


def test_packed_documents(odd, odd_rows, none, encode):
    rows = pack_documents(odd, VOCABULARY, block_tokens=5000).collect()
    want = sorted(((k is not None, k), crc(encode(t) + [1])) for k, t, *_ in odd_rows)
    whole = [((r.doc_id is not None, r.doc_id), r.ids_crc32) for r in rows if r.length == r.doc_tokens]
    cut = {r.doc_id for r in rows if r.length < r.doc_tokens}
    assert set(whole) <= set(want) and sum(r.length for r in rows) == sum(
        len(encode(t)) + 1 for _, t, *_ in odd_rows
    )
    long = next(t for k, t, *_ in odd_rows if k == 9)
    ids = encode(long) + [1]
    assert 9 in cut
    for r in (r for r in rows if r.doc_id == 9):
        assert r.ids_crc32 == crc(ids[r.start : r.start + r.length])
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length, r.tier))
    for pieces in sequences.values():
        at = 0
        for offset, length, tier in sorted(pieces):
            assert offset == at
            at += length
        assert at == tier
    assert pack_documents(none, VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        pack_documents(none, VOCABULARY, tiers=(100, 200))


def test_checksums():
    assert crc32c([b"123456789"])[0] == 0xE3069283
    strings = [os.urandom(n) for n in (4, 63, 64, 65, 128, 129, 1000, 5001)]
    assert crc32c(strings).tolist() == [int(crc32c([s])[0]) for s in strings]
    # a published frame: its length field of eight bytes and the masked checksum of that
    assert int(masked(crc32c([(0).to_bytes(8, "little")]))[0]) == 0x07980329


def test_frames_are_checked():
    data = b"".join(frames([b"some payload", b"another one"]))
    assert payloads_of(data, [12, 11]) == [b"some payload", b"another one"]
    for at in (0, 9, 14, 25):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(RecordError):
            payloads_of(bytes(bad), [12, 11])
    with pytest.raises(RecordError):
        payloads_of(data[:-1], [12, 11])


def test_records_round_trip(odd, odd_rows, none, encode):
    got = token_records(odd, VOCABULARY).orderBy("start").collect()
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = sorted(((k is not None, k or 0), len(encode(t)) + 1, crc(encode(t) + [0])) for k, t, *_ in odd_rows)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.n_tokens, r.ids_crc32) for r in got) == want
    assert token_records(none, VOCABULARY).count() == 0


def test_single_records_are_read_by_the_index(spark, tmp_path, encode):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(20)], "doc_id long, text string")
    files = write_records(df.coalesce(1), str(tmp_path), VOCABULARY).collect()
    name = max(files, key=lambda f: f.records)
    some = read_some(str(tmp_path), name.file, [name.records - 1, 0])
    assert len(some) == 2 and len(some[0]) > 9 and some[0] != some[1]
