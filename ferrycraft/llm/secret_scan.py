"""Secrets in texts and in what they encode: a worklist of decoded layers until nothing new appears."""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrycraft.llm.blocks import blocks, texts_of, with_columns

#: Kinds in the order that breaks ties of spans with one start.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
#: An assignment can't be in a text without one of these before its sign; a cheap test for most texts.
SIGN = re.compile(r"(?:word|passwd|secret|token|key)[\"']?\x20*[:=]", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+|&#(?:[xX][0-9A-Fa-f]{1,6}|[0-9]{1,7});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
#: Runs of base64 on lines below each other, of any width, also indented, quoted or as string literals.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:(?:[\"'][\x20\t]*[+,]?)?\\?[\x20\t]*\r?\n[\x20\t>#*|\"']*[A-Za-z0-9+/_-]++)++={0,2}")
BETWEEN = re.compile(r"(?:[\"'][\x20\t]*[+,]?)?\\?[\x20\t]*\r?\n[\x20\t>#*|\"']*")
#: How gzip, bz2, xz, zstd and zlib streams begin in base64.
HEADS = re.compile(r"H4sI|Qlpo|/Td6WFo|KLUv/|eA[E-H]|eF[4-7]|eJ[w-z]|eN[o-r]")
#: Characters of base64 by which a stream is told from a chance likeness of its head.
HEAD = 1024
#: Bytes that a compressed layer is unwrapped by at a time; larger ones are scanned in pieces, and counted.
LAYER_BYTES = 64 << 20
#: Bytes that a piece repeats of the one before, for secrets across the cut.
OVERLAP = 1 << 20
#: Bytes that a stream is fed and read by.
STEP = 1 << 16
ZLIB = type(zlib.decompressobj())
#: Memory that an xz or zstd window may take; streams that ask for more are refused, and counted.
WINDOW_BYTES = 256 << 20

Span = tuple[int, int, int]


def base_spans(text: str) -> Iterator[Span]:
    """(start, end, kind) of secrets that stand in the text itself."""
    if SIGN.search(text):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield m.start(), m.end(), 0
    if "AKIA" in text:
        yield from ((m.start(), m.end(), 1) for m in ACCESS.finditer(text))
    yield from ((m.start(), m.end(), 2) for m in HEX.finditer(text))


class Layer:
    """A text and where its characters come from: pieces (first character, origin start, origin end, one to one)."""

    def __init__(self, text: str, pieces: list[tuple[int, int, int, bool]]) -> None:
        self.text, self.pieces = text, pieces
        self.firsts = [p[0] for p in pieces]

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The span of the document that ``start`` … ``end`` of this layer comes from."""
        first, low, high, plain = self.pieces[bisect_right(self.firsts, start) - 1]
        begin = low + start - first if plain else low
        first, low, high, plain = self.pieces[bisect_right(self.firsts, end - 1) - 1]
        return begin, low + end - first if plain else high


def _escaped(run: str) -> str:
    if run.startswith("&#"):
        number = run[2:-1]
        points = [int(number[1:], 16) if number[0] in "xX" else int(number)]
    elif run.startswith("\\u{"):
        points = [int(run[3:-1], 16)]
    elif run.startswith("\\u"):
        units = b"".join(int(run[i:i + 4], 16).to_bytes(2, "big") for i in range(2, len(run), 6))
        return units.decode("utf-16-be", "replace")
    else:
        return _text(bytes(int(run[i:i + 2], 16) for i in range(2, len(run), 4)))
    return "".join(chr(p) if p < 0x110000 and not 0xD800 <= p < 0xE000 else "�" for p in points)


def _text(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("latin-1")


def _rewritten(layer: Layer, pattern: re.Pattern, decode: Callable[[str], str]) -> Layer | None:
    """The layer with every match of the pattern decoded, other characters where they are."""
    out, pieces, at, length = [], [], 0, 0

    def copy(end: int) -> None:
        nonlocal at, length
        while at < end:  # a stretch of the layer falls into as many pieces as it came in
            number = bisect_right(layer.firsts, at) - 1
            first, low, high, plain = layer.pieces[number]
            stop = min(end, layer.firsts[number + 1] if number + 1 < len(layer.firsts) else end)
            pieces.append((length, low + at - first, low + stop - first, True) if plain else (length, low, high, False))
            out.append(layer.text[at:stop])
            length, at = length + stop - at, stop

    for m in pattern.finditer(layer.text):
        copy(m.start())
        low, high = layer.origin(*m.span())
        decoded = decode(m[0])
        if decoded:
            pieces.append((length, low, high, False))
            out.append(decoded)
            length += len(decoded)
        at = m.end()
    if not out or not at:
        return None
    copy(len(layer.text))
    return Layer("".join(out), pieces)


def _engine(data: bytes):
    """A decompressor for the stream that the bytes begin with, if any."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor(memlimit=WINDOW_BYTES)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=WINDOW_BYTES).decompressobj()
    return None


def _member(engine, data: bytes) -> Iterator[bytes]:
    """What one member holds, in bounded steps; returns the bytes behind it."""
    zstd = not isinstance(engine, (ZLIB, bz2.BZ2Decompressor, lzma.LZMADecompressor))
    step = 256 if zstd else STEP  # zstd doesn't bound what it returns
    for low in range(0, len(data), step):
        part = data[low:low + step]
        out = engine.decompress(part) if zstd else engine.decompress(part, STEP)
        yield out
        while not zstd and not engine.eof and (out if isinstance(engine, ZLIB) else not engine.needs_input):
            out = engine.decompress(getattr(engine, "unconsumed_tail", b""), STEP)
            yield out
        if engine.eof:
            return engine.unused_data + data[low + step:]
    return b""


def _unpacked(data: bytes, limit: int) -> Iterator[bytes | None]:
    """The content of a compressed stream, all its members, in pieces of about ``limit`` bytes that overlap.

    None, once each, for coming to more than ``limit`` bytes and for a window over WINDOW_BYTES; nothing for other bytes.
    """
    held, fresh, cut, refused = bytearray(), 0, False, False
    while (engine := _engine(data)) is not None:
        member = _member(engine, data)
        data = b""
        while True:
            try:
                out = next(member)
            except StopIteration as end:  # further members, perhaps behind padding
                data = end.value if _engine(end.value) is not None else end.value.lstrip(b"\0")
                break
            except (zlib.error, OSError, lzma.LZMAError, EOFError, zstandard.ZstdError) as error:
                refused |= "memory" in str(error).lower()
                break
            for low in range(0, len(out), limit):
                if fresh and len(held) + len(out) - low > limit:
                    yield bytes(held)
                    del held[:-min(OVERLAP, limit // 2)]
                    fresh, cut = 0, True
                held += out[low:low + limit]
                fresh += len(out[low:low + limit])
    if fresh:
        yield bytes(held)
    if cut or refused:
        yield None


def _readable(data: bytes) -> str | None:
    """The text of decoded bytes when they are one: UTF-8 without control characters but white space."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not any(ord(c) < 32 and c not in "\t\n\r" or ord(c) == 127 for c in text) else None


def _content(data: bytes, limit: int) -> str | None:
    """The text of bytes that are no stream, when they are readable or a rule or a decoder hits in them."""
    text = _readable(data)
    if text is None:
        text = _text(data)
        if not (BASE64.search(text) or PERCENT.search(text) or ESCAPE.search(text) or WRAPPED.search(text)
                or next(base_spans(text), None)):
            return None
    return text


def _decoded(body: str) -> bytes:
    body = body[:len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _bodies(text: str) -> Iterator[tuple[int, int, str]]:
    """Stretches that may be base64: both alphabets, with or without padding, on one line or wrapped."""
    for m in WRAPPED.finditer(text):
        body = BETWEEN.sub("", m[0]).rstrip("=").replace("-", "+").replace("_", "/")
        if len(body) >= 12:
            yield m.start(), m.end(), body
    for m in BASE64.finditer(text):
        yield m.start(), m.end(), m[0].rstrip("=").replace("-", "+").replace("_", "/")


def _from_base64(body: str, limit: int) -> Iterator[str | None]:
    """What a stretch of base64 holds: streams from wherever one begins, else its text at the four alignments."""
    whole = False
    for m in HEADS.finditer(body):
        head, at = _decoded(body[m.start():m.start() + HEAD]), m.start()
        if len(body) - at > HEAD and not _begins(head):
            continue
        for piece in _unpacked(_decoded(body[at:]), limit):
            whole |= at == 0 and piece is not None
            yield None if piece is None else _text(piece)
    if not whole:
        for shift in range(4):
            text = _content(_decoded(body[shift:]), limit)
            if text:
                yield text


def _begins(head: bytes) -> bool:
    """Whether the first bytes of a stream raise no error, though nothing may come out yet."""
    try:
        for _ in _member(_engine(head), head):
            pass
    except (zlib.error, OSError, lzma.LZMAError, EOFError, zstandard.ZstdError) as error:
        return "memory" in str(error).lower()
    return True


def _below(layer: Layer) -> Callable[..., Iterator[Layer | None]]:
    def made(start: int, end: int, texts: Iterator[str | None]) -> Iterator[Layer | None]:
        place = layer.origin(start, end)
        for text in texts:
            if text is None:
                yield None
            elif text:
                yield Layer(text, [(0, *place, False)])
    return made


def _streams(data: bytes, limit: int) -> Iterator[str | None]:
    return (None if piece is None else _text(piece) for piece in _unpacked(data, limit))


def _layers_of(layer: Layer, limit: int) -> Iterator[Layer | None]:
    """The layers right below one, made as they are asked for."""
    below = _below(layer)
    if "%" in layer.text:
        yield from filter(None, [_rewritten(layer, PERCENT, lambda run: _text(bytes.fromhex(run.replace("%", ""))))])
        for m in PERCENT.finditer(layer.text):  # bytes of a compressed stream
            yield from below(m.start(), m.end(), _streams(bytes.fromhex(m[0].replace("%", "")), limit))
    if "\\" in layer.text or "&#" in layer.text:
        yield from filter(None, [_rewritten(layer, ESCAPE, _escaped)])
        for m in ESCAPE.finditer(layer.text):
            if m[0].startswith("\\x"):
                data = bytes(int(m[0][i:i + 2], 16) for i in range(2, len(m[0]), 4))
                yield from below(m.start(), m.end(), _streams(data, limit))
    for start, end, body in _bodies(layer.text):
        yield from below(start, end, _from_base64(body, limit))


def layers(text: str, limit: int = LAYER_BYTES) -> Iterator[Layer | None]:
    """Every layer below the text, depth first, so that few are held at once; None for a stream cut or refused.

    A layer that was seen at the same place is not taken up again, so streams that unwrap to themselves end.
    """
    if "%" not in text and "\\" not in text and "&#" not in text and not BASE64.search(text) and not WRAPPED.search(text):
        return
    seen = {(0, len(text), _mark(text))}
    todo = [_layers_of(Layer(text, [(0, 0, len(text), True)]), limit)]
    while todo:
        below = next(todo[-1], todo)
        if below is todo:
            todo.pop()
        elif below is None:
            yield None
        elif (place := (*below.origin(0, len(below.text)), _mark(below.text))) not in seen:
            seen.add(place)
            yield below
            todo.append(_layers_of(below, limit))


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def scan(text: str, limit: int = LAYER_BYTES) -> tuple[list[Span], list[Span], int]:
    """Base spans, all spans, both in order, and the number of streams scanned in pieces or refused."""
    base = sorted(base_spans(text))
    every, skipped = set(base), 0
    for layer in layers(text, limit):
        if layer is None:
            skipped += 1
            continue
        every.update((*layer.origin(start, end), kind) for start, end, kind in base_spans(layer.text))
    return base, sorted(every, key=lambda s: (s[0], s[2], s[1])), skipped


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LAYER_BYTES,
                 keep_text: bool = False) -> DataFrame:
    """``(key, base, spans, skipped)`` for every row; both lists hold ``kind``, ``start`` and ``end`` in code points.

    ``base`` are secrets in the text itself. ``spans`` adds what decoded layers hold (percent and Unicode escapes,
    base64, compressed streams, nested in any order), mapped to the characters of the text they come from; a layer
    inside base64 or a compressed stream maps to the whole of it. A span that is there already is not added again.
    Base64 is read at all four alignments and across lines, streams from wherever they begin in it. ``skipped`` counts
    streams that come to more than ``limit`` bytes, which are scanned whole but in overlapping pieces, and streams whose
    window is over WINDOW_BYTES, which are not unwrapped. NULL and empty texts have no spans; repeated rows and NULL keys are kept; further columns are ignored. With ``keep_text``
    the text, NULL as empty, comes second.
    """
    kept_columns = [key, "text"] if keep_text else [key]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[kind], "start": start, "end": end} for start, end, kind in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = [scan(t.decode(), limit) for t in block.texts()]
            yield with_columns(block, kept_columns, base=pa.array([rows(b) for b, _, _ in found], span),
                               spans=pa.array([rows(s) for _, s, _ in found], span),
                               skipped=pa.array([n for _, _, n in found], pa.int32()))

    source = texts_of(docs, key, text=text)
    one = F.array(F.struct(F.lit("").alias("kind"), F.lit(0).alias("start"), F.lit(0).alias("end")))
    return source.mapInArrow(run, source.select(
        *kept_columns, one.alias("base"), one.alias("spans"), F.lit(0).alias("skipped")).schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover, overlapping or touching ones as one, replaced by ``mark``."""
    start = F.struct(F.lit(0).alias("end"), F.lit("").alias("text"))
    done = F.aggregate(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b")))),
                       start, lambda acc, s: F.when(
        (s["a"] <= acc["end"]) & (acc["end"] > 0), F.struct(F.greatest(acc["end"], s["b"]).alias("end"), acc["text"].alias("text"))
    ).otherwise(F.struct(s["b"].alias("end"), F.concat(
        acc["text"], F.substring(text, acc["end"] + 1, s["a"] - acc["end"]), F.lit(mark)).alias("text"))))
    return F.when(F.size(spans) > 0, F.concat(done["text"], F.substring(text, done["end"] + 1, F.length(text)))).otherwise(text)
