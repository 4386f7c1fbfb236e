"""Byte-level BPE as a streaming transducer with bounded lookahead.

A merge list fixes how far to the right the bytes can still change a token. Let two
texts share a prefix and then differ. Before any merge the two segmentations differ
from the end of the prefix on; a merge ``(u, v)`` moves that point left by ``len(u)``
only if ``v`` starts exactly there in one of the two runs, and such steps happen at
strictly rising ranks. The step before it was some ``(u', v')`` whose ``u'`` starts
``v`` in either run, so ``u'`` is on the chain of first parts of ``v``. The longest such
chain is found in one pass over the merges (:meth:`BpeModel.sufficient_lookahead`):
every token that ends at least that many bytes before the end of the buffer is final.

The encoder keeps a buffer of that length plus a constant, emits final tokens, and
never looks at the rest of a piece again, so a piece of any length takes constant
memory. The decoder feeds token bytes to an incremental UTF-8 machine that holds at
most three pending bytes between two steps.

Vocabulary files are read on the driver (their size is bounded by the vocabulary) and
broadcast. Defined results: null and empty texts give no tokens and an empty text;
every row of the input gives one row, repeated rows included.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K

#: Largest vocabulary file that is broadcast.
MAX_VOCAB_BYTES = 64 << 20
#: Memo of short pieces per Python worker: entries, and the longest piece kept.
MEMO_ENTRIES = 1 << 18
MEMO_CHARS = 32
#: Characters of text that are cut into pieces at a time, ids that are decoded at a time.
STEP = 1 << 16



def _class(wanted) -> str:
    """A character class body of the code points that ``wanted`` holds for."""
    ranges, begin = [], None
    for c in range(sys.maxunicode + 2):
        if c <= sys.maxunicode and wanted(c):
            begin = c if begin is None else begin
        elif begin is not None:
            ranges.append(f"\\U{begin:08x}-\\U{c - 1:08x}")
            begin = None
    return "".join(ranges)


#: Letters and numbers of Unicode 16, which the interpreter's own table
#: (15.1) doesn't have yet.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
]


def _has(kind: str, more: list[tuple[int, int]]):
    extra = {c for a, b in more for c in range(a, b + 1)}
    return lambda c: unicodedata.category(chr(c))[0] == kind or c in extra


_LETTER = _class(_has("L", NEW_LETTERS))
_NUMBER = _class(_has("N", NEW_NUMBERS))
_SPACE = _class(lambda c: c in (*range(9, 14), 0x85) or unicodedata.category(chr(c))[0] == "Z")
#: Fixed value: the byte-level splitting pattern, its character classes spelled out.
PIECES = rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


def byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 stands for itself, the
    others for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    for k, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + k)
    return table


class BpeModel:
    """Vocabulary, merges by rank, and the lookahead that makes tokens final."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], special: dict[str, int] | None = None):
        back = {c: b for b, c in byte_alphabet().items()}
        self.special = dict(special or {})
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()], default=-1))
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.byte_id = [vocab.get(c, -1) for _, c in sorted(byte_alphabet().items())]
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            self.rules[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.lookahead = self.sufficient_lookahead()
        made = {self.byte_id[b] for b in range(256)}
        self.proper = all(i >= 0 for i in self.byte_id)
        for (a, b), (_, ab) in self.rules.items():  # parts exist before a rule, and every token is made by one rule
            self.proper &= a in made and b in made and ab not in made
            made.add(ab)
        self.by_bytes = {self.bytes[i]: i for i in made if i >= 0}
        self.longest = max(map(len, self.by_bytes), default=1)
        self.pairs, self.alone = _Pairs(self), _ALONE
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces = re.compile(PIECES)
        self.cut = re.compile(rf"(?<=[^{_SPACE}])[{_SPACE}]")

    @classmethod
    def from_json(cls, text: str) -> BpeModel:
        d = json.loads(text)
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in d["model"]["merges"]]
        return cls(d["model"]["vocab"], merges, {t["content"]: t["id"] for t in d.get("added_tokens", [])})

    def sufficient_lookahead(self) -> int:
        """Bytes by which a change to the right can move token borders to the left."""
        farthest: dict[int, int] = {}  # by left part: the longest chain that ends with a rule of that left part
        chain: dict[int, int] = {}  # by token: the longest chain that ends at a left part on its chain of first parts
        most = 0
        for (u, v), (_, uv) in self.rules.items():
            reach = len(self.bytes[u]) + max(chain.get(v, 0), farthest.get(v, 0))
            farthest[u] = max(farthest.get(u, 0), reach)
            chain[uv] = max(chain.get(uv, 0), chain.get(u, 0), farthest[u])
            most = max(most, reach)
        return most

    def segment(self, data: bytes) -> list[int]:
        """The tokens of a byte string.

        A sequence of tokens is the segmentation of its bytes if and only if every
        neighbouring pair is the segmentation of its own bytes (for a proper merge list,
        see :attr:`proper`). So the longest token that goes with the one before it is
        taken, with steps back where nothing fits; every prefix has one segmentation, so a
        border that failed once never returns. Pair verdicts come from :meth:`merge`."""
        if not self.proper:
            return self.merge(data)
        n, out, pos, most = len(data), [], 0, self.longest
        get, pairs, dead = self.by_bytes.get, self.pairs, set()
        while pos < n:
            size = min(most, n - pos)
            while size:
                token = get(data[pos:pos + size])
                if token is not None and pos + size not in dead and pairs[(out[-1] << 32 if out else self.alone) | token]:
                    break
                size -= 1
            if size:
                out.append(token)
                pos += size
                most = self.longest
            else:
                dead.add(pos)
                most = len(self.bytes[out.pop()]) - 1
                pos -= most + 1
        return out

    def merge(self, data: bytes) -> list[int]:
        """The tokens of a byte string by its definition: lowest rank first, leftmost first."""
        return self._merge([self.byte_id[b] for b in data])

    def _merge(self, ids: list[int]) -> list[int]:
        """A heap over a linked list: n log n for a whole buffer."""
        n, rules = len(ids), self.rules
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rules[p][0], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in rules]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = rules[pair][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := (ids[i], ids[after[i]])) in rules:
                    heapq.heappush(heap, (rules[p][0], i, p))
            if before[i] >= 0 and (p := (ids[before[i]], ids[i])) in rules:
                heapq.heappush(heap, (rules[p][0], before[i], p))
        return [t for t in ids if t >= 0]


#: Stands for no token in front.
_ALONE = 0xFFFFFFFF << 32


class _Pairs(dict):
    """Whether two tokens side by side (or one with none in front) are the segmentation of
    their bytes. Filled on demand and emptied at a fixed size."""

    def __init__(self, model: BpeModel):
        super().__init__()
        self.model = model

    def __missing__(self, key: int) -> bool:
        a, b = key >> 32, key & 0xFFFFFFFF
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        pair = [b] if a == 0xFFFFFFFF else [a, b]
        good = self[key] = self.model.merge(b"".join(self.model.bytes[t] for t in pair)) == pair
        return good


class Transducer:
    """Bytes of one piece in, token ids out as soon as they are final."""

    def __init__(self, model: BpeModel):
        self.model, self.buffer = model, b""
        self.room = 4 * model.lookahead + 256

    def feed(self, data: bytes) -> Iterator[int]:
        for at in range(0, len(data), self.room):
            self.buffer += data[at:at + self.room]
            if len(self.buffer) < self.room:
                continue
            end, final = 0, len(self.buffer) - self.model.lookahead
            for token in self.model.segment(self.buffer):
                if end + len(self.model.bytes[token]) > final:
                    break
                end += len(self.model.bytes[token])
                yield token
            self.buffer = self.buffer[end:]

    def finish(self) -> list[int]:
        left, self.buffer = self.buffer, b""
        return self.model.segment(left)


class _Memo(dict):
    """Packed ids by piece. Short pieces are kept, up to a fixed number; the method is
    the same for all."""

    def __init__(self, model: BpeModel):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> bytes:
        run = Transducer(self.model)
        ids = [*run.feed(piece.encode()), *run.finish()]
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_CHARS and len(self) < MEMO_ENTRIES:
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder over whole texts, a step at a time."""

    def __init__(self, model: BpeModel):
        self.model, self.memo = model, _Memo(model)

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed little-endian unsigned 32-bit ids, step by step."""
        model = self.model
        for part in model.split_special.split(text) if model.split_special else [text]:
            if part in model.special:
                yield model.special[part].to_bytes(4, "little")
                continue
            at = 0
            while at < len(part):
                # a white-space character after another one always begins a piece
                cut = model.cut.search(part, at + STEP)
                to = cut.start() if cut else len(part)
                yield b"".join(map(self.memo.__getitem__, model.pieces.findall(part, at, to)))
                at = to

    def decode(self, packed: Iterable[bytes]) -> Iterator[str]:
        """Text of the ids, step by step; a character whose bytes lie in two tokens is held back."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        table = self.model.bytes.__getitem__
        for ids in packed:
            for at in range(0, len(ids), 4 * STEP):
                yield machine.decode(b"".join(map(table, np.frombuffer(ids[at:at + 4 * STEP], "<u4").tolist())))
        yield machine.decode(b"", True)


_codecs: dict[str, Codec] = {}


def _codec(text: str, key: str) -> Codec:
    if key not in _codecs:
        _codecs[key] = Codec(BpeModel.from_json(text))
    return _codecs[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_VOCAB_BYTES + 1)
    if len(text) > MAX_VOCAB_BYTES:
        raise ValueError(f"vocabulary file over {MAX_VOCAB_BYTES} bytes")
    return text


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``tokens`` (array of ids), one row per row of ``docs``."""
    return _coded(docs, vocabulary, id_col, text_col, "tokens array<bigint>", lambda codec, text: (
        np.frombuffer(b"".join(codec.encode(text)), "<u4").astype(np.int64),))


def decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "tokens", out_col: str = "text") -> DataFrame:
    """The inverse of :func:`encode`: ``id_col`` and the text of the ids (null ids: empty)."""
    text = read_vocabulary(vocabulary)
    shared, key = docs_broadcast(tokens, text)
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared.value, key)
        out = ["".join(codec.decode([np.array(ids.as_py() or [], "<u4").tobytes()])) for ids in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, out_col])

    return K.text_map(tokens.select(id_col, ids_col), run, f"{id_col} {kind}, {out_col} string")


def docs_broadcast(df: DataFrame, text: str):
    return df.sparkSession.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest()


def _digests(codec: Codec, text: str) -> tuple[int, str, str]:
    n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()

    def ids() -> Iterator[bytes]:
        nonlocal n
        for packed in codec.encode(text):
            n += len(packed) // 4
            ids_sha.update(packed)
            yield packed

    for decoded in codec.decode(ids()):
        text_sha.update(decoded.encode())
    return n, ids_sha.hexdigest(), text_sha.hexdigest()


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; ids and text are hashed
    step by step and never held whole."""
    return _coded(docs, vocabulary, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests)


def _coded(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, columns: str, one) -> DataFrame:
    text = read_vocabulary(vocabulary)
    shared, key = docs_broadcast(docs, text)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [c.strip().split(" ")[0] for c in columns.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    types = [kinds[c.strip().split(" ")[1]] for c in columns.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared.value, key)
        rows = [one(codec, t.as_py() or "") for t in batch.column(1)]
        cols = [pa.array([r[i] for r in rows], types[i]) for i in range(len(names))]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, *names])

    return K.text_map(docs.select(id_col, text_col), run, f"{id_col} {kind}, {columns}")
