"""Operator 6: byte-level BPE encoding by a lazily determinised transducer, and streaming decode.

The merges of a rank file are compiled on demand into a finite-state transducer
over bytes.  It rests on a property of BPE: a token sequence is the encoding of
its bytes exactly when every two neighbours, encoded on their own, stay as they
are.  So every prefix of a text has one last token, found from the last tokens
of shorter prefixes.  A state is the bytes after the last certain token boundary
and the last tokens of their prefixes.  A boundary is certain, and its tokens are
emitted, once every start from which a longer vocabulary entry can still grow has
it in its past; no more bytes than these entries reach over are ever held back.
A state forgets what was emitted before it, which keeps states few; emitted
neighbours are checked, and a piece where they would merge is encoded again with
the whole past in view.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .tables import documents
from .worker import kept_table

VOCABULARY = "byte_bpe_50k.tiktoken"
STATES = 300_000
PIECES = 350_000
_BYTES = [bytes((i,)) for i in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class _State(dict):
    """A state: its transitions by byte, made when first taken.

    ``ends``: for each prefix of the pending bytes, where its last token starts, and
    that token.  ``live``: where a token may start that ends later.
    """

    __slots__ = ("ends", "live", "pending")

    def __init__(self, pending: bytes, ends: list[tuple[int, int]], live: list[int]):
        self.pending, self.ends, self.live = pending, ends, live


class Transducer:
    """Bytes in, token ids out; states and transitions are made when first met.

    ``states`` bounds the states in memory: a full machine is emptied between
    pieces, as lazy automata do, which changes no result.
    """

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self._ranks, self._bytes = ranks, {rank: token for token, rank in ranks.items()}
        # One entry per token and proper prefix of a token: 2 * rank (or -2), plus 1 for a prefix.
        prefixes = {token[:n] for token in ranks for n in range(1, len(token))}
        self._entries = {x: 2 * ranks.get(x, -1) + 1 for x in prefixes}
        self._entries |= {x: 2 * rank for x, rank in ranks.items() if x not in prefixes}
        self._fits: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._bound = states
        self._reset()

    def _reset(self) -> None:
        self._start = _State(b"", [(-1, -1)], [0])
        self._states: dict[bytes, _State] = {b"": self._start}

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merge into a token last; null for a byte.

        A vocabulary entry that merging its own bytes never reaches gives (-1, -1).
        """
        if token in self._halves:
            return self._halves[token]
        text = self._bytes[token]
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 2:
            found = [self._ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            best = min((rank for rank in found if rank is not None), default=None)
            if best is None:
                break
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        halves = None
        if len(parts) == 2:
            halves = (self._ranks[parts[0]], self._ranks[parts[1]])
        elif len(parts) > 2:
            halves = (-1, -1)
        self._halves[token] = halves
        return halves

    def _may_follow(self, left: int, right: int) -> bool:
        if left < 0:
            return self._split(right) != (-1, -1)
        fits = self._fits.get(left << 32 | right)
        if fits is None:
            if len(self._fits) > self._bound:
                self._fits.clear()
            fits = self._fits[left << 32 | right] = self._stay(left, right)
        return fits

    def _stay(self, left: int, right: int) -> bool:
        """Whether two neighbours stay as they are when their bytes are encoded together.

        Their merges are undone from the latest to the earliest.  Should the parts
        that then touch make a token of a lower rank than the merge just undone, that
        token would have been made first.  A merge on the left goes before one of the
        same rank on its right.
        """
        if self._split(right) == (-1, -1):
            return False
        before = len(self._ranks) + 1
        while True:
            joined = self._ranks.get(self._bytes[left] + self._bytes[right])
            if joined is not None and joined < before:
                return False
            halves_left, halves_right = self._split(left), self._split(right)
            if halves_left is None and halves_right is None:
                return True
            if halves_right is None or (halves_left is not None and left > right):
                before, left = left, halves_left[1]
            else:
                before, right = right + 1, halves_right[0]

    def _grow(self, text: bytes, end: int, ends: list[tuple[int, int]], live: list[int]) -> list[int]:
        """Append the last token of the first ``end`` bytes; returns the starts that still live."""
        entry_of, still, grown = self._entries.get, [], False
        for i in live:
            entry = entry_of(text[i:end])
            if entry is None:
                continue
            if entry & 1:
                still.append(i)
            if entry >= 0 and not grown and self._may_follow(ends[i][1], entry >> 1):
                ends.append((i, entry >> 1))
                grown = True
        still.append(end)
        return still

    def _last_tokens(self, text: bytes) -> tuple[list[tuple[int, int]], list[int]]:
        ends, live = [(-1, -1)], [0]
        for end in range(1, len(text) + 1):
            live = self._grow(text, end, ends, live)
        return ends, live

    def _step(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        """Make the transition of a state on a byte: the next state and the tokens now certain."""
        pending, ends = state.pending + _BYTES[byte], state.ends[:]
        live = self._grow(pending, len(pending), ends, state.live)
        tokens: tuple[int, ...] = ()
        if cut := self._common(ends, live):
            tokens, pending = self._chain(ends, cut), pending[cut:]
        following = self._states.get(pending)
        if following is None:
            if cut:
                ends, live = self._last_tokens(pending)
            following = self._states[pending] = _State(pending, ends, live)
        state[byte] = result = (following, tokens)
        return result

    @staticmethod
    def _common(ends: list[tuple[int, int]], live: list[int]) -> int:
        """The last boundary in the past of every live start."""
        first = live[0]
        if not first:
            return 0
        meet = first
        for i in live[1:]:
            while i != meet:
                if i > meet:
                    i = ends[i][0]
                else:
                    meet = ends[meet][0]
        return meet

    @staticmethod
    def _chain(ends: list[tuple[int, int]], at: int) -> tuple[int, ...]:
        tokens = []
        while at > 0:
            at, token = ends[at]
            tokens.append(token)
        return tuple(tokens[::-1])

    def encode(self, piece: bytes) -> list[int]:
        whole = self._ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._states) > self._bound:
            for state in self._states.values():
                state.clear()  # states refer to each other: let go of them without a collector
            self._reset()
        state, ids, last = self._start, [], -1
        for byte in piece:
            state, tokens = state.get(byte) or self._step(state, byte)
            if tokens:
                if not self._may_follow(last, tokens[0]):
                    return self._with_past(piece)
                ids.extend(tokens)
                last = tokens[-1]
        rest = self._chain(state.ends, len(state.ends) - 1)
        if rest and not self._may_follow(last, rest[0]):
            return self._with_past(piece)
        ids.extend(rest)
        return ids

    def _with_past(self, piece: bytes) -> list[int]:
        ends, _ = self._last_tokens(piece)
        return list(self._chain(ends, len(piece)))


class _Pieces(dict):
    """Packed token ids of pieces seen before: two generations of at most ``bound`` each."""

    def __init__(self, machine: Transducer, bound: int = PIECES):
        super().__init__()
        self._machine, self._older, self._bound = machine, {}, bound

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            ids = np.array(self._machine.encode(piece.encode()), dtype=np.int32).tobytes()
        if len(piece) <= 64:
            if len(self) >= self._bound:
                self._older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


# White space, letters and numbers up to U+024F, where the classes of the public pattern are
# these few ranges and the standard library's matcher, twice as fast, can be used.
_SPACE, _LETTER, _NUMBER = r"\t-\r\x20\x85\xa0", "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
_PLAIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_OTHER = re.compile("[^\x00-ɏ]")
_FULL = regex.compile(public_tokenizers.PATTERN)


def split(text: str) -> list[str]:
    """The matches of the public pattern."""
    return (_FULL if _OTHER.search(text) else _PLAIN).findall(text)


def encoder(path: str, remembered: int = PIECES) -> _Pieces:
    """``remembered`` bounds the pieces and states that a worker holds; results do not depend on it."""
    made = ("bpe", path, remembered)
    return kept_table(made, lambda: _Pieces(Transducer(read_ranks(path), remembered), remembered))


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


class Utf8Stream:
    """An incremental UTF-8 decoder: a state machine over lead and continuation bytes.

    ``feed`` returns the characters that are complete; the state between calls is
    the started character (at most three bytes).  Bytes that cannot belong to a
    character become U+FFFD, as in Python's ``replace`` mode.
    """

    def __init__(self):
        self._started = b""

    @staticmethod
    def _needed(lead: int) -> int:
        if 0xC2 <= lead <= 0xDF:
            return 2
        if 0xE0 <= lead <= 0xEF:
            return 3
        return 4 if 0xF0 <= lead <= 0xF4 else 1

    @staticmethod
    def _second_fits(lead: int, second: int) -> bool:
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
        return low <= second <= {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)

    def feed(self, data: bytes) -> str:
        data = self._started + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if 0x80 <= byte <= 0xBF:
                continue
            fits = back < 2 or self._second_fits(byte, data[len(data) - back + 1])
            if self._needed(byte) > back and fits:
                cut -= back
            break
        self._started = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self._started = self._started, b""
        return rest.decode("utf-8", "replace")


def decode_stream(
    ids: Sequence[int], vocabulary: dict[int, bytes], at_once: int = 16_384
) -> Iterator[str]:
    """Text of a sequence of ids, part by part; an unknown id is an error."""
    stream = Utf8Stream()
    for at in range(0, len(ids), at_once):
        yield stream.feed(b"".join(map(vocabulary.__getitem__, ids[at : at + at_once])))
    yield stream.end()


def decode_bytes(data: bytes, at_once: int = 1 << 16) -> str:
    """Text of decoded bytes, fed to the state machine in parts."""
    stream = Utf8Stream()
    fed = [stream.feed(data[i : i + at_once]) for i in range(0, len(data), at_once)]
    return "".join(fed) + stream.end()


def _kept(df: DataFrame, *replaced: str) -> list[str]:
    return [c for c in df.columns if c not in replaced]


def _encoded(texts: list[str | None], known: _Pieces) -> list[np.ndarray]:
    packed = (b"".join(map(known.__getitem__, split(text or ""))) for text in texts)
    return [np.frombuffer(ids, dtype=np.int32) for ids in packed]


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, ids)])
    flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)


def _parts(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` without its text, and with ``token_ids`` (array of int).

    Null and empty texts have no tokens.  All other columns are kept as they
    are; a column of the name ``token_ids`` is replaced.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    kept = _kept(docs, text, "token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for part in _parts(batches):
            ids = _encoded(part.column(text).to_pylist(), known)
            columns = [part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, _id_lists(ids)], [*kept, "token_ids"])

    schema = docs.select(*kept).schema.add("token_ids", ArrayType(IntegerType()))
    return docs.select(*kept, text).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str | None = None, ids: str = "token_ids") -> DataFrame:
    """``tokens`` with ``decoded`` (binary: the bytes) and ``decoded_text`` (string).

    A null id list decodes to no bytes; columns of these names are replaced.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    kept = _kept(tokens, "decoded", "decoded_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = token_bytes(path)
        for part in _parts(batches):
            lists = [value.values for value in part.column(ids)]
            lists = [[] if value is None else value.to_numpy().tolist() for value in lists]
            raw = [b"".join(map(vocabulary.__getitem__, value)) for value in lists]
            arrays = [pa.array(raw, pa.binary()), pa.array(map(decode_bytes, raw), pa.string())]
            columns = [part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], [*kept, "decoded", "decoded_text"])

    schema = tokens.select(*kept).schema.add("decoded", "binary").add("decoded_text", "string")
    return tokens.mapInArrow(run, schema)


def round_trip(
    docs: DataFrame, path: str | None = None, text: str = "text", remembered: int = PIECES
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``token_ids`` and ``decoded`` (binary).

    The bytes are decoded from the ids, not copied from the text.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    kept = _kept(docs, text, "token_ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, vocabulary = encoder(path, remembered), token_bytes(path)
        for part in _parts(batches):
            ids = _encoded(part.column(text).to_pylist(), known)
            texts = ("".join(decode_stream(value.tolist(), vocabulary)) for value in ids)
            raw = pa.array([value.encode() for value in texts], pa.binary())
            columns = [part.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, _id_lists(ids), raw], [*kept, "token_ids", "decoded"]
            )

    schema = docs.select(*kept).schema
    schema = schema.add("token_ids", ArrayType(IntegerType())).add("decoded", "binary")
    return docs.select(*kept, text).mapInArrow(run, schema)


def digest(decoded: DataFrame) -> DataFrame:
    """Per document: how many tokens, and the digests of its ids and of their decoded bytes."""
    joined = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op6_byte_bpe(spark, folder: str) -> DataFrame:
    """Encode and decode every document: digests of ids and bytes."""
    return digest(round_trip(documents(spark, folder).select("doc_id", "text")))
