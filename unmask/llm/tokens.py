"""Encoders for public vocabularies, fast on many texts through a bounded store of encoded pieces.

Texts are cut, a slice of them at a time, where the tokenizer always cuts; each distinct piece is encoded once by
the library and remembered, and a document's ids are its pieces' ids one after another: the same ids as encoding
the whole text. A store is limited in bytes, holds no long piece, and is cut down to its oldest, most frequent
pieces when a task ends; a worker holds the vocabularies of one operator at a time.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Callable, Iterable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402

# Bytes that a store may hold in a task and after it; longer chunks are not remembered.
STORE_BYTES = 32_000_000
REST_BYTES = 8_000_000
# What a store may hold where the task holds little else; a third stays after it.
WIDE_STORE_BYTES = 96_000_000
LONGEST_CHUNK = 64
# What an entry costs beside its chunk and ids.
_ENTRY_BYTES = 180
PART = 32_768
# A byte that no UTF-8 text holds stands around texts.
_BETWEEN = b"\xff"
# What a byte tells of its character: white space of ASCII, the space, a letter of ASCII, a mark of ASCII, surely no white
# space to end or to begin with.
_BLANK, _SPACE, _LETTER, _MARK, _ENDS, _BEGINS = 1, 2, 4, 8, 16, 32


def _kinds() -> bytes:
    kinds = bytearray(256)
    for b in range(256):
        c = chr(b)
        if c in "\t\n\v\f\r ":
            kinds[b] = _BLANK | (_SPACE if c == " " else 0)
        elif 0x21 <= b <= 0x7E:
            kinds[b] = _ENDS | _BEGINS | (_LETTER if c.isalpha() else 0 if c.isdigit() else _MARK)
        # All other white space begins with one of the bytes that are left out.
        elif 0xC3 <= b <= 0xF4 and b not in (0xE1, 0xE2, 0xE3):
            kinds[b] = _BEGINS
    return bytes(kinds)


_KINDS = _kinds()
_TO_SPACES = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_TO_LOWER_AND_SPACES = _TO_SPACES.translate(bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)))
# Letters of ASCII or Latin-1 after a space.
_WORD = re.compile(rb" (?:[A-Za-z]+|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# No white space but a space before; what holds bytes of other white space is left out.
_SOLID = re.compile(rb" ?[^\x00-\x20\xc2\xe1-\xe3]+")


class Store(dict):
    """chunk -> its ids as little-endian unsigned 32-bit integers.

    Short chunks stay until ``limit`` bytes are held, which soon are all the frequent ones. Others are held
    for the texts at hand only: ``learn`` names them and ``forget`` takes them out again.
    """

    def __init__(self, encode: Callable[[list], Iterable[bytes]], limit: int = STORE_BYTES):
        self.encode, self.limit, self.held = encode, limit, 0

    def put(self, chunk: str | bytes, ids: bytes) -> bool:
        """Hold a chunk; False if only for now."""
        self[chunk] = ids
        cost = len(chunk) + len(ids) + _ENTRY_BYTES
        if len(chunk) > LONGEST_CHUNK or self.held + cost > self.limit:
            return False
        self.held += cost
        return True

    def learn(self, chunks: Iterable) -> list:
        # Membership one by one: a difference with the keys would walk the whole store.
        todo, passing = [c for c in chunks if c not in self], []
        for at in range(0, len(todo), PART):
            part = todo[at : at + PART]
            found = list(zip(part, self.encode(part), strict=True))
            if self.held + _ENTRY_BYTES > self.limit:
                self.update(found)
                passing += part
            else:
                passing += [c for c, ids in found if not self.put(c, ids)]
        return passing

    def forget(self, chunks: list) -> None:
        for chunk in chunks:
            del self[chunk]

    def rest(self, limit: int = REST_BYTES) -> None:
        """Keep the oldest chunks only, as a task ends."""
        if self.held <= limit:
            return
        oldest, held = [], 0
        for chunk, ids in self.items():
            held += len(chunk) + len(ids) + _ENTRY_BYTES
            if held > limit:
                break
            oldest.append((chunk, ids))
        self.clear()
        self.held = 0
        for chunk, ids in oldest:
            self.put(chunk, ids)


class JsonEncoder:
    """A vocabulary file of the ``tokenizers`` library; strings of special tokens are ordinary text.

    Texts are cut at white space and where a mark follows a letter, as both kinds of file split there: byte-level
    files keep a single space with the word after it, the others drop white space.
    """

    def __init__(self, path: str, limit: int = STORE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_space = self.tokenizer.normalizer is None
        self.store = Store(self._encode, limit)
        # The same vocabulary for words of letters, which the file's other steps would leave as they are.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "merged_with_next" if self.keeps_space else "removed"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        # Ids that begin with a space, or that end a word.
        pieces = self.tokenizer.get_vocab()
        mark = (lambda p: p[0] == "Ġ") if self.keeps_space else (lambda p: p.endswith("</w>"))
        self.marks = np.zeros(max(pieces.values()) + 1, dtype=bool)
        self.marks[[i for p, i in pieces.items() if mark(p)]] = True
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces. Words, and what makes lines, are encoded as one string each."""
        words = [_WORD.fullmatch(p) is not None for p in pieces]
        # Line ends tell lines apart only where the file keeps white space.
        lines = [self.keeps_space and not w and p != _BETWEEN and _SOLID.fullmatch(p) is not None for p, w in zip(pieces, words, strict=True)]
        of_words = iter(self._of_words(b"".join(itertools.compress(pieces, words)).decode()))
        of_lines = iter(self._of_lines(b"\n".join(itertools.compress(pieces, lines)).decode()))
        alone = [p.decode() if p != _BETWEEN else "" for p, w, x in zip(pieces, words, lines, strict=True) if not (w or x)]
        rest = (np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False))
        return [next(of_words if w else of_lines if x else rest) for w, x in zip(words, lines, strict=True)]

    def _of_words(self, text: str) -> list[bytes]:
        found = self.words.encode_batch_fast([text if self.keeps_space else text.lower()], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        packed, marks = ids.tobytes(), np.flatnonzero(self.marks[ids]) * 4
        bounds = [*marks.tolist(), len(packed)] if self.keeps_space else [0, *(marks + 4).tolist()]
        return [packed[x:y] for x, y in itertools.pairwise(bounds)]

    def _of_lines(self, text: str) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        packed, ends = ids.tobytes(), np.flatnonzero(np.isin(ids, self.line_end)) * 4
        return [packed[x:y] for x, y in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(packed)], strict=True)]

    def _cuts(self, texts: list[str]) -> tuple[bytes, np.ndarray]:
        """The texts' bytes, each text between two marks, and the places in them where pieces begin."""
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        if not self.keeps_space:
            # Lower case is the file's own step after joining letters and accents; A-Z go first where no accent may follow.
            parts = [p.translate(_TO_SPACES if b"\xcc" in p or b"\xcd" in p else _TO_LOWER_AND_SPACES) for p in parts]
        data = _BETWEEN.join([b"", *parts, b""])
        a, kind = np.frombuffer(data, dtype=np.uint8), np.frombuffer(data.translate(_KINDS), dtype=np.uint8)
        here, before, after = kind[1:-1], kind[:-2], kind[2:]
        latin = np.zeros(len(before), dtype=bool)
        latin[1:] = (a[:-3] == 0xC3) & (a[1:-2] != 0x97) & (a[1:-2] != 0xB7)
        cut = np.zeros(len(a), dtype=bool)
        inner = ((here & _MARK) > 0) & (((before & _LETTER) > 0) | latin)
        if self.keeps_space:
            # The last of some white space is apart from the others, and a space goes with the word after it.
            inner |= ((here & _BLANK) > 0) & (((before & _ENDS) > 0) | latin | ((after & _BEGINS) > 0))
            inner |= ((here & _BEGINS) > 0) & ((before & (_BLANK | _SPACE)) == _BLANK)
        else:
            inner |= (here & _SPACE) > 0
        cut[1:-1] = inner
        between = np.flatnonzero(a == _BETWEEN[0])
        cut[between] = True
        cut[between[:-1] + 1] = True
        return data, np.flatnonzero(cut)

    def rest(self) -> None:
        """To be called as a task ends."""
        self.store.rest(self.store.limit // 3)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, packed as the store packs them."""
        if not texts:
            return []
        data, at = self._cuts(texts)
        kind, width = (pa.binary(), np.int32) if len(data) < 1 << 31 else (pa.large_binary(), np.int64)
        buffers = [None, pa.py_buffer(np.append(at, len(data)).astype(width)), pa.py_buffer(data)]
        found = pa.Array.from_buffers(kind, len(at), buffers).dictionary_encode()
        code, pieces = found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False).tolist()
        passing = self.store.learn(pieces)
        packed = list(map(self.store.__getitem__, pieces))
        self.store.forget(passing)
        size = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        place = np.cumsum(size) - size
        n = size[code]
        starts = np.cumsum(n) - n
        ids = np.frombuffer(b"".join(packed), dtype="<u4")[np.repeat(place[code] - starts, n) + np.arange(n.sum())].tobytes()
        bounds = (4 * starts[np.frombuffer(data, dtype=np.uint8)[at] == _BETWEEN[0]]).tolist()
        return [ids[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


_held: dict = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` loads, one for each worker process; what another key loaded goes first."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def json_encoder(path: str, limit: int = STORE_BYTES) -> JsonEncoder:
    return held(("json", path, limit), lambda: JsonEncoder(path, limit))


def slices(texts: list, chars: int = 2_000_000) -> Iterable[tuple[int, int]]:
    """Ranges of a list with about so many characters each, so that long texts do not pile up."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
