"""Operator 2: personal data by fixed patterns, and by a BiLSTM-CRF learned from their spans.

The base patterns find e-mail addresses, IP addresses, card and phone numbers.
A network trained on the labelled spans of a bounded sample, also rewritten in
other common notations, finds spans that the patterns miss.  A span of any kind
holds an at sign or several digits close together; only around such places can
the network's tags lead to a span, so only there is it run, over windows that
overlap.  Scores of a character from several windows are averaged, those near a
window's middle counting more, and one Viterbi pass decodes each whole region.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .pii_model import KINDS, TAGS, Network, Settings, character_classes
from .tables import documents
from .textbytes import Piece, per_row, pieces, task_pieces

SAMPLE_ROWS = 3000
SAMPLE_WINDOWS = 3000
LEAST_DIGITS = 4
DIGIT_REACH = 24
Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A digit run is entered at its start only: entering later could not match either.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT_OR_AT = np.zeros(256, dtype=np.int64)
_DIGIT_OR_AT[[*range(48, 58), 64]] = 1


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        twice = digit * 2 if i % 2 else digit
        total += twice - 9 if twice > 9 else twice
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield "email", start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by kind, then start, in code points, end exclusive.

    Matches of a kind are leftmost and do not overlap; those that fail their
    check are dropped.  Linear in the text's length.
    """
    found = list(_emails(text))
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = digits_of(m[0]) if len(m[0]) <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def regions(points: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Stretches of a text in which a span can lie, with half a window of context around."""
    digit = ((points >= 48) & (points < 58)).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum(digit)))
    ends = np.minimum(np.arange(len(points)) + DIGIT_REACH, len(points))
    dense = (digit > 0) & (sums[ends] - sums[:-1] >= LEAST_DIGITS)
    marks = np.flatnonzero(dense | (points == 64))
    if not len(marks):
        return []
    lows = np.maximum(marks - window // 2, 0)
    highs = np.minimum(marks + DIGIT_REACH + window // 2, len(points))
    breaks = np.flatnonzero(lows[1:] > highs[:-1]) + 1
    firsts, lasts = np.concatenate(([0], breaks)), np.concatenate((breaks, [len(marks)])) - 1
    return list(zip(lows[firsts].tolist(), highs[lasts].tolist(), strict=True))


def _window_starts(low: int, high: int, settings: Settings) -> list[int]:
    last = max(low, high - settings.window)
    return [*range(low, last, settings.stride), last]


def _plausible(kind: str, text: str) -> bool:
    """What a span of a kind must hold, whatever its notation."""
    digits = digits_of(text)
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+\s?@\s?[^\s@]+\.[^\s@]+", text))
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(part) <= 3 and int(part) <= 255 for part in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", text)
    groups = re.findall("[0-9]+", text)
    shaped = len(groups) >= 3 or text.startswith(("+", "("))
    return 8 <= len(digits) <= 15 and shaped and not re.search("[A-Za-z@]", text)


class Finder:
    """Base spans and, given a network, the spans that it adds."""

    def __init__(self, network: Network | None):
        self._network = network

    def _scores(self, classes: list[np.ndarray]) -> list[np.ndarray]:
        """Emission scores of whole regions, averaged over their overlapping windows."""
        s = self._network.settings
        places, windows = [], []
        for i, region in enumerate(classes):
            for start in _window_starts(0, len(region), s):
                part = region[start : start + s.window]
                places.append((i, start, len(part)))
                windows.append(np.pad(part, (0, s.window - len(part)), constant_values=0))
        weight = 1 + np.minimum(np.arange(s.window), np.arange(s.window)[::-1])
        totals = [np.zeros((len(region), TAGS)) for region in classes]
        sums = [np.zeros(len(region)) for region in classes]
        for at in range(0, len(windows), 512):
            scores = self._network.emissions(np.array(windows[at : at + 512]))
            for (i, start, size), score in zip(places[at : at + 512], scores, strict=True):
                totals[i][start : start + size] += score[:size] * weight[:size, None]
                sums[i][start : start + size] += weight[:size]
        return [total / weights[:, None] for total, weights in zip(totals, sums, strict=True)]

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """Spans of the network alone: they overlap no base span and no other of their own."""
        out: list[list[Span]] = [[] for _ in texts]
        if self._network is None:
            return out
        owners, classes = [], []
        for i, text in enumerate(texts):
            points = _points(text)
            for low, high in regions(points, self._network.settings.window):
                owners.append((i, low))
                classes.append(character_classes(points[low:high]))
        for (i, low), scores in zip(owners, self._scores(classes), strict=True):
            tags = self._network.viterbi(scores)
            for at in np.flatnonzero(tags % 2 == 1).tolist():
                end = at + 1
                while end < len(tags) and tags[end] == tags[at] + 1:
                    end += 1
                kind, start, stop = KINDS[(tags[at] - 1) // 2], low + at, low + end
                clear = all(stop <= a or start >= b for _, a, b in base[i])
                if clear and _plausible(kind, texts[i][start:stop]):
                    out[i].append((kind, start, stop))
        return out

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
        """All spans by kind, then start; the flag tells base spans."""
        base = [base_spans(text) for text in texts]
        result = []
        for own, more in zip(base, self.added(texts, base), strict=True):
            every = [(*span, True) for span in own] + [(*span, False) for span in more]
            result.append(sorted(every, key=lambda x: (KINDS.index(x[0]), x[1])))
        return result


def _rewritten(kind: str, text: str) -> list[str]:
    """The same datum in notations that the patterns do not know."""
    digits = digits_of(text)
    if kind == "phone" and len(digits) >= 10:
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"]
    if kind == "email":
        return [text.replace("@", " @ ")]
    if kind == "card" and len(digits) == 16:
        return [".".join(digits[i : i + 4] for i in range(0, 16, 4))]
    return []


def training_windows(text: str, settings: Settings) -> list[tuple[str, list[Span]]]:
    """Labelled windows of a text around places where spans can lie, plain and rewritten."""
    base, made = base_spans(text), []
    for low, high in regions(_points(text), settings.window):
        for start in _window_starts(low, high, settings):
            part = text[start : start + settings.window]
            inside = [(k, a - start, b - start) for k, a, b in base if a < start + len(part) and b > start]
            made.append((part, [(k, max(a, 0), min(b, len(part))) for k, a, b in inside]))
    for kind, start, end in base:
        for other in _rewritten(kind, text[start:end]):
            before = text[max(0, start - (settings.window - len(other)) // 2) : start]
            part = (before + other + text[end : end + settings.window])[: settings.window]
            if len(before) + len(other) <= len(part):
                made.append((part, [(kind, len(before), len(before) + len(other))]))
    return made


def train(labelled: Iterable[tuple[str, list[Span]]], settings: Settings | None = None) -> Network | None:
    """A network fitted to labelled windows; None if no window has a span."""
    settings = settings or Settings()
    labelled = list(labelled)
    if not any(spans for _, spans in labelled):
        return None
    windows = np.zeros((len(labelled), settings.window), dtype=np.int64)
    tags = np.zeros((len(labelled), settings.window), dtype=np.int64)
    for i, (text, spans) in enumerate(labelled):
        windows[i, : len(text)] = character_classes(_points(text))
        for kind, start, end in spans:
            tag = 1 + 2 * KINDS.index(kind)
            tags[i, start:end] = tag + 1
            tags[i, start] = tag
    network = Network(settings)
    network.fit(windows, tags)
    return network


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
)


def sample(
    docs: DataFrame, settings: Settings, rows: int = SAMPLE_ROWS, windows: int = SAMPLE_WINDOWS
) -> list[tuple[str, list[Span]]]:
    """Labelled windows of at most ``rows`` documents, those of the smallest digest of doc_id.

    Only windows leave the tasks, at most ``windows`` of them, chosen by digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            made = [w for i in _touched(piece) for w in training_windows(piece.text(i), settings)]
            spans = ["|".join(f"{k}:{a}:{b}" for k, a, b in own) for _, own in made]
            arrays = [pa.array([part for part, _ in made], pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "spans"])

    order = F.md5(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id").distinct().orderBy(order, "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text")
    made = texts.mapInArrow(run, "part string, spans string").distinct()
    found = made.orderBy(F.length("spans") == 0, F.md5("part"), "part").limit(windows).collect()

    def parsed(spans: str) -> list[Span]:
        items = (item.split(":") for item in spans.split("|") if item)
        return [(kind, int(a), int(b)) for kind, a, b in items]

    return [(row.part, parsed(row.spans)) for row in found]


def _touched(piece: Piece) -> list[int]:
    """Rows of a piece with a digit or an at sign: the others hold no span."""
    return np.flatnonzero(per_row(_DIGIT_OR_AT[piece.data], piece.offsets)).tolist()


def find(docs: DataFrame, network: Network | None, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs``, without its text unless asked, with ``spans``: structs (kind, start, end, base).

    Null counts as empty.  A column of the name ``spans`` is replaced, all others kept.
    """
    kept = [c for c in docs.columns if (keep_text or c != text) and c != "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(network)
        for piece in task_pieces(batches, text):
            at = _touched(piece)
            spans: list[list] = [[] for _ in range(len(piece))]
            for i, own in zip(at, finder.spans([piece.text(i) for i in at]), strict=True):
                spans[i] = [dict(zip(("kind", "start", "end", "base"), x, strict=True)) for x in own]
            columns = [piece.rows.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, _ARROW_SPANS)], [*kept, "spans"])

    read = docs.select(*dict.fromkeys([*kept, text]))
    schema = docs.select(*kept).withColumn("spans", F.lit(None).cast(SPANS)).schema
    return read.mapInArrow(run, schema)


def redacted(text: str, spans: Iterable[tuple[str, int, int, bool]]) -> str:
    """A text with its spans, joined where they overlap, replaced by the name of their kind."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` with personal data masked in ``text``; same columns, a null text stays null.

    ``n_chars``, where it is a column and the text changed, follows the new length.
    """
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    text = own["text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(network)
        for piece in task_pieces(batches, text):
            at = _touched(piece)
            old = piece.rows.column(text).to_pylist()
            for i, spans in zip(at, finder.spans([old[i] for i in at]), strict=True):
                old[i] = redacted(old[i], spans)
            arrays = [
                pa.array(old, pa.string()) if c == text else piece.rows.column(c) for c in own.values()
            ]
            yield pa.RecordBatch.from_arrays(arrays, list(own.values()))

    frame = docs.toDF(*own.values())
    masked = frame.mapInArrow(run, frame.schema)
    if "n_chars" in own:
        kind = dict(frame.dtypes)[own["n_chars"]]
        length = F.coalesce(F.length(text).cast(kind), F.col(own["n_chars"]))
        masked = masked.withColumn(own["n_chars"], length)
    return masked.toDF(*docs.columns)


def _listed(spans: Column) -> Column:
    texts = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast(StringType()), s["end"].cast(StringType())),
    )
    return F.array_join(texts, ",")


def digest(found: DataFrame) -> DataFrame:
    """Per document: base counts per kind, the digest of the base spans, and all spans."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def learned(docs: DataFrame, settings: Settings | None = None) -> Network | None:
    settings = settings or Settings()
    return train(sample(docs, settings), settings)


def op2_bilstm_pii(spark, folder: str) -> DataFrame:
    """Find personal data in every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    return digest(find(docs, learned(docs)))
