"""Alignment of two tokenizers against a plain version, on texts of odd signs and with every way of counting pairs."""

import hashlib
import random
from collections import Counter

import pytest

from jobtide.llm import token_alignment as ta

public_tokenizers = pytest.importorskip("public_tokenizers")


def plain(texts):
    """One row per text, by loops over freshly loaded tokenizers."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    hidden = [x for x in range(256) if x not in shown]
    byte = {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(hidden)}
    rows, all_links = [], []
    for text in texts:
        want = (" " + (text or "")).encode()
        ta_, tb = [], []
        if text:
            enc = a.encode(" " + text, add_special_tokens=False)
            ta_ = [(i, bytes(byte[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
            for i in b.encode(text):
                p = b.id_to_piece(i)
                tb.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        if b"".join(x for _, x in ta_) != want or b"".join(x for _, x in tb) != want:
            ta_, tb = [], []

        def spans(tokens):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            return out

        sa, sb = spans(ta_), spans(tb)
        both = sorted({e for *_, e in sa} & {e for *_, e in sb})
        groups = []
        start = 0
        for e in both:
            groups.append(",".join(str(i) for i, s, t in sa if start < t <= e) + "|" + ",".join(str(i) for i, s, t in sb if start < t <= e))
            start = e
        links = [(i, j) for i, s, e in sa for j, u, v in sb if s < v and u < e]
        all_links += links
        rows.append((len(sa), len(sb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if sa else ""))
    count = Counter(all_links)
    most: Counter = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(na, nb, ng, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), sha) for na, nb, ng, links, sha in rows]


def odd_texts():
    rng = random.Random(5)
    parts = ["a", "the", "Straße", "don't", "  ", " ", "\n", "\t", "…", "😀", "日本語", "▁", "<s>", "</s>", "<0x41>", "<|endoftext|>", " ", "é", "é", "1234", "--", "​", "naïve", "Ωmega", "ﬁ", "\x00", "word"]
    made = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "  "]) for _ in range(rng.randint(1, 25))) for _ in range(120)]
    return [None, "", " ", "   ", "a ", " a", "a", "the cat", "the cat", "x" * 500, *made]


@pytest.mark.parametrize("frequent", [ta.FREQUENT, 40, 0])
def test_equals_plain_version(spark, docs_frame, frequent):
    texts = odd_texts()
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: tuple(r)[1:] for r in ta.align_documents(docs_frame(rows), frequent=frequent).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    for i, want in enumerate(plain(texts)):
        assert got[i] == want, texts[i]


def test_remembered_words_and_blocks_change_nothing():
    texts = [t or "" for t in odd_texts()]
    forgetful, other = ta.Aligner(None, None, 1), ta.Aligner(None, None, 1000)
    other.b.by_word = False
    whole = forgetful.align(texts)
    assert whole == [forgetful.align([t])[0] for t in texts] == other.align(texts)


def test_pairs_come_back():
    import numpy as np

    keys, n = np.array([3 << 20 | 7, 3 << 20 | 9, 50_000 << 20 | 31_999]), np.array([1, 70_000, 5])
    for size in (0, 1, 3):
        got = ta.unpack_pairs(ta.pack_pairs(keys[:size], n[:size], 20), 20)
        assert got[0].tolist() == keys[:size].tolist() and got[1].tolist() == n[:size].tolist()


def test_null_ids_repeats_clashes_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, "the cat", 1), (4, "the cat", 2), (4, "the cat", 3)], "doc_id long, text string, pairs int").withColumnRenamed("pairs", "row")
    got = ta.align_documents(rows).collect()
    assert sorted(str(r.doc_id) for r in got) == ["4", "4", "None"] and len({tuple(r)[1:] for r in got}) == 1 and got[0].count_sum == 3 * got[0].n_links
    assert ta.align_documents(rows.limit(0)).collect() == []
