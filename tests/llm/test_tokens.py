import random
import zlib

import numpy as np
import pytest

import public_tokenizers
from tokenizers import Tokenizer

from jobtide.llm import packing, token_store, tokens
from jobtide.llm.common import scratch_path
from jobtide.llm.tokens import Encoder

ODD = ["", " ", "  a", "a  b", " \n x\n \ny", "a\n b", "don't we'll 12.5x  \t\tz ", "é à b c", "x" * 3000, "<|endoftext|> a", "a <|endoftext|>  b<|endoftext|><|endoftext|> é", "日<|endoftext|> 日", "it's 's ''s \n've x'll'd", "²a b²c 12² Ⅷ", "a \n\n b \n", "日本語 テスト。 abc", "\x1c a\x1d\x1eb", "\x85 a", "a\0 b"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def plain():
    """The plain call on a tokenizer that nothing else has touched."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("letters", [" \n\t'aébs.,!%1²日\x85\xa0  \x1cdon", " \n''strevelmd.ß1½\xa0\x85", "".join(map(chr, range(1, 0x240))) + " \n's" * 50, " \n\u0240\u0300é\u3000\u4e2d\U0001f600a"])
def test_encoder_equals_tokenizer_on_whole_texts(plain, letters):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    for text, raw in zip(texts, Encoder(pieces=50).encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == plain(text), repr(text)


def test_encoder_cuts_long_texts_where_the_tokenizer_does(plain, monkeypatch):
    monkeypatch.setattr(tokens, "SECTION", 30)
    text = " ".join(ODD) * 3
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder().encode([text, "", "a b", text])] == [plain(t) for t in (text, "", "a b", text)]


def test_encoder_of_another_tokenizer_is_the_plain_call():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for text, raw in zip(ODD, Encoder(path).encode(ODD), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for n in (0, 1, 4095, 4096, 10_000):
        ids = rng.integers(0, 2**32 if n == 1 else 50257, n, dtype="u8").astype("<u4")
        assert np.array_equal(token_store.restore_planes(token_store.shuffle_planes(ids, bits=bits)), ids)


def test_store_round_trip(spark, docs_frame, plain):
    texts = ODD + [None, "word " * 5000, "same", "same"]
    rows = [(3 * i % 101, t) for i, t in enumerate(texts)]
    path = token_store.write_tokens(docs_frame(rows).repartition(3), scratch_path(spark, "test"), chunk_tokens=40)
    got = token_store.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    at = 0
    for (key, text), r in zip(sorted(rows), got, strict=True):
        ids = [*plain(text), 0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, list(r.ids)) == (key, at, len(ids), crc(ids), ids)
        at += len(ids)


def test_store_of_no_documents(spark, docs_frame):
    path = token_store.write_tokens(docs_frame([]), scratch_path(spark, "test"))
    assert token_store.read_tokens(spark, path).count() == 0


def test_piece_starts():
    assert packing.piece_starts(1, 4) == [0] and packing.piece_starts(4, 4) == [0] and packing.piece_starts(5, 4) == [0, 1] and packing.piece_starts(8, 4) == [0, 4]


def test_open_bins_takes_the_tightest_and_closes_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 2)
    for n in (6, 8, 9):
        bins.place(n)  # the bin with 8 closes
    assert bins.place(2) == (0, 6) and bins.place(1) == (2, 9)


def test_packing_is_gapless_and_whole(spark, docs_frame, plain):
    rng = random.Random(2)
    rows = [(i, "alpha beta " * rng.randint(0, 700)) for i in range(300)] + [(300, None), (7, "again"), (None, "no id")]
    got = packing.pack_documents(docs_frame(rows).repartition(2), window=50).toPandas()
    assert (got.length <= 1024).all()
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.r_[0, g.length.cumsum().to_numpy()[:-1]]).all() and g.length.sum() <= 1024
    want = []
    for key, text in rows:
        ids = [*plain(text), 2]
        starts = packing.piece_starts(len(ids), 1024)
        want += [(key if key is not None else -1, k, s, crc(ids[s:e])) for k, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    assert sorted(want) == sorted(map(tuple, got[["doc_id", "piece", "start", "ids_crc32"]].fillna(-1).astype("int64").values.tolist()))
    assert got.sequence_id.nunique() <= got.length.sum() / 1024 * 1.05 + 2
