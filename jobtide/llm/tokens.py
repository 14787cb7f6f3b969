"""Fast, exact, bounded-memory encoding of whole texts with the `tokenizers` library.

A byte-level BPE first splits a text by a fixed pattern and then merges inside each piece. Here the pieces of a
whole block of texts are marked at once in its UTF-8 bytes (`piece_starts`), equal pieces are found by Arrow,
and only different pieces that are not remembered (in two generations of bounded size) reach the BPE of the library.

* Letters, digits and white space are looked up for characters below U+0240, whose classes no Unicode version has
  changed. Texts with other characters are cut before white space that follows something else, which
  always is a cut of the pattern, and their words go to the whole tokenizer.
* The string of an added token in a text is that token, as in a plain call: texts are cut at such strings first.
* Tokenizers of another kind (normalisers, other patterns) get whole texts, one by one.
* Texts beyond `SECTION` characters are cut before white space, so memory does not grow with a text. A run without any white
  space is one word, however long.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_cache

#: Unicode White_Space, as the tokenizer's pattern understands \s (fixed values).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORDS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_WORD_GAP = re.compile(f"(?<=[^{_WS}])(?=[{_WS}])")
#: Texts longer than this many characters are encoded in sections; a block of texts has about as many.
SECTION = 1 << 23
#: Pieces that a worker remembers, in each of two generations.
PIECES = 500_000

SPACE, LETTER, NUMBER, OTHER = range(4)
#: First byte of the characters from U+0240 on, which have no entry in the class table.
_BEYOND = 0xC9


def _char_class(code: int) -> int:
    if code in (0x20, 0x85, 0xA0) or 9 <= code <= 13:
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(code))[0], OTHER)


_CLASSES = np.array([_char_class(c) for c in range(0x240)], "u1")
_BYTE_CLASSES = np.concatenate([_CLASSES[:128], np.full(128, OTHER, "u1")])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TwoGenerations:
    """A dict of at most 2 x `limit` entries; entries used since the last turn survive the next."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def get_all(self, keys: list) -> list:
        found = list(map(self.new.get, keys))
        if None in found and self.old:
            found = [self.get(k) if x is None else x for k, x in zip(keys, found)]
        return found


def piece_starts(raw: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Byte positions where the pieces of texts begin that lie one after the other in `raw` (UTF-8, below U+0240).

    The pattern: contractions ('s 't 're 've 'm 'll 'd), an optional space with a run of letters, of numbers or of other
    signs, white space up to the last one before something else, white space.
    """
    n = len(raw)
    kind = _BYTE_CLASSES[raw]
    lead = np.flatnonzero(raw >= 0xC2)
    kind[lead] = kind[lead + 1] = _CLASSES[((raw[lead] & 0x1F).astype("i4") << 6) | (raw[lead + 1] & 0x3F)]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    start = np.empty(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start |= first
    start[0] = True
    # the last white space of a run goes with what follows if it is a space, and stands alone if not
    begin = np.flatnonzero(start[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~first[1:n]) + 1
    last = begin - 1
    last -= (raw[last] & 0xC0) == 0x80
    start[last] = True
    start[begin[raw[last] == 0x20]] = False
    marks = np.flatnonzero(raw == 0x27)
    if len(marks):
        padded = np.concatenate([raw, np.zeros(3, "u1")])
        ends = np.concatenate([first, np.ones(3, bool)])
        marks = marks[start[marks] & ~ends[marks + 1]]
        a, b = padded[marks + 1], padded[marks + 2]
        one = np.isin(a, np.frombuffer(b"stmd", "u1"))
        two = (((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C)) & ~ends[marks + 2]
        whole = one | two
        start[marks[whole] + 1] = False
        start[marks[one] + 2] = True
        start[marks[two] + 3] = True
    return np.flatnonzero(start[:n])


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def shared_encoder(path: str | None, pieces: int = PIECES) -> Encoder:
    """One encoder for a Python worker, so that later tasks of it find the pieces of earlier ones."""
    return worker_cache(f"encoder {path} {pieces}", lambda: Encoder(path, pieces))


class Encoder:
    """encode(texts) gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str | None = None, pieces: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_tokenizer())
        self.model = self.tokenizer.model
        self.pieces = TwoGenerations(pieces)
        self.words = TwoGenerations(pieces // 4)
        self.letters = _byte_letters()
        self.space = self.letters[32]
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        self.plain_added = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values())
        self.added_at = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.byte_level = self._is_byte_level()

    def _is_byte_level(self) -> bool:
        before = self.tokenizer.pre_tokenizer
        state = json.loads(before.__getstate__()) if before is not None else {}
        model = json.loads(self.model.__getstate__())
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        return (
            self.tokenizer.normalizer is None and self.tokenizer.truncation is None and self.tokenizer.padding is None
            and state.get("type") == "ByteLevel" and state.get("use_regex") is True and state.get("add_prefix_space") is False
            and model.get("type") == "BPE" and not any(model.get(o) for o in options)
        )

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of single pieces, by the BPE itself: its input is the letters of their bytes."""
        letters, space, packed, tokenize = self.letters, self.space, self.packed, self.model.tokenize
        out = []
        for p in pieces:
            known = p.replace(" ", space) if p.isascii() and p.isprintable() else "".join([letters[b] for b in p.encode()])
            ids = b"".join([packed[t.id] for t in tokenize(known)])
            self.pieces.put(p, ids)
            out.append(ids)
        return out

    def _latin(self, texts: pa.Array) -> list[bytes]:
        """Texts of a block, all below U+0240."""
        ends = np.frombuffer(texts.buffers()[1], "i4", len(texts) + 1, 4 * texts.offset)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, "u1", int(ends[-1] - ends[0]), int(ends[0])) if ends[-1] > ends[0] else np.zeros(0, "u1")
        begins = (ends - ends[0]).astype("i4")
        if not len(raw):
            return [b""] * len(texts)
        starts = piece_starts(raw, begins[:-1][begins[:-1] < len(raw)])
        offsets = np.append(starts, len(raw)).astype("i4")
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        different = pieces.dictionary.to_pylist()
        ids = self.pieces.get_all(different)
        new = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(new, self._learn([different[i] for i in new]), strict=True):
            ids[i] = x
        of_text = pa.array(np.searchsorted(starts, begins).astype("i4"))
        return pc.binary_join(pa.ListArray.from_arrays(of_text, pa.array(ids, pa.binary()).take(pieces.indices)), b"").to_pylist()

    def _other(self, text: str) -> bytes:
        words = _WORDS.findall(text)
        ids = self.words.get_all(words)
        new = list({w for w, x in zip(words, ids) if x is None})
        if new:
            fresh = {}
            for w, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                fresh[w] = np.array(e.ids, "<u4").tobytes()
                if len(w) < 100:
                    self.words.put(w, fresh[w])
            ids = [fresh[w] if x is None else x for w, x in zip(words, ids)]
        return b"".join(ids)

    def _block(self, texts: list[str]) -> list[bytes]:
        whole = pa.array(texts, pa.string())
        ends = np.frombuffer(whole.buffers()[1], "i4", len(texts) + 1)
        raw = np.frombuffer(whole.buffers()[2] or b"", "u1", int(ends[-1]))
        beyond = np.flatnonzero(raw >= _BEYOND)
        if not len(beyond):
            return self._latin(whole)
        other = np.zeros(len(texts), bool)
        other[np.searchsorted(ends, beyond, "right") - 1] = True
        latin = iter(self._latin(whole.filter(pa.array(~other))))
        return [self._other(t) if o else next(latin) for t, o in zip(texts, other.tolist())]

    def _parts(self, text: str) -> list[str | int]:
        """Sections of a text to encode, and ids of the added tokens between them."""
        whole = self.added_at.split(text) if self.added_at is not None and any(t in text for t in self.added) else [text]
        parts: list[str | int] = []
        for k, part in enumerate(whole):
            if k % 2:
                parts.append(self.added[part])
                continue
            at = 0
            while len(part) - at > SECTION and (gap := _WORD_GAP.search(part, at + SECTION)):
                parts.append(part[at : gap.start()])
                at = gap.start()
            parts.append(part[at:])
        return parts

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.byte_level:
            return [self._plain(t) for t in texts]
        out: list[bytes | None] = [None] * len(texts)
        held: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            for (i, _), ids in zip(held, self._block([t for _, t in held]), strict=True):
                out[i] = ids if out[i] is None else out[i] + ids
            held.clear()

        for i, text in enumerate(texts):
            if len(text) <= SECTION and not any(t in text for t in self.added):
                held.append((i, text))
                size += len(text)
            elif not self.plain_added and any(t in text for t in self.added):
                out[i] = self._plain(text)
            else:
                ids = [p.to_bytes(4, "little") if isinstance(p, int) else self._block([p])[0] for p in self._parts(text)]
                out[i] = b"".join(ids)
            if size >= SECTION:
                flush()
                size = 0
        if held:
            flush()
        return out
