"""Secret scans with a recursive decoding worklist.

Every text is scanned as it is (the base spans). Then a worklist unwraps what is encoded in it:
percent escapes, Unicode and character escapes, base64, and compressed data inside base64. Each
unwrapped layer is scanned again and put on the worklist itself, until nothing new turns up. A layer
that was seen before at the same place (a cycle) is not taken up again. Every character of a layer
knows the span of the original text it came from, so matches in any layer are reported at their
place in the original.

Kinds, leftmost non-overlapping each: ``assign`` (a key word, a value of 12+ characters), ``access``
(``AKIA``, 18+), ``hex`` (16+). Offsets are code points, ends exclusive.

Defined cases: null and empty texts have no spans; rows are independent, so repeated rows repeat
their result; an empty table gives an empty result; other columns are ignored by ``scan`` and kept
unchanged by ``redact``. Texts of any length are scanned whole. Base64 is read in both alphabets, over
line breaks and from each of its first four characters, and every decoded layer is scanned, text or
not. Compressed data is unpacked wherever it begins in a layer, with all its members and to any
depth. Decoded layers are read in overlapping windows of bounded size, so memory stays bounded and
nothing is left out that fits in the overlap; what follows damage in compressed data is left out.
"""

from __future__ import annotations

import base64
import bisect
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Generator, Iterable, Iterator
from functools import partial
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmend.llm.common import small_batches

try:
    import zstandard
except ImportError:  # without it zstd data stays packed
    zstandard = None

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2})"
                    r"|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
#: Both alphabets, with single line breaks (and indents) where a run is wrapped.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{22}|[A-Za-z0-9+/_-]++[\x20\t]*\r?\n)"
                    r"[A-Za-z0-9+/_-]++(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)*+")
#: 16 bytes, the shortest secret, take 22 characters.
MIN_BASE64 = 22
_STANDARD = str.maketrans("-_", "+/", " \t\r\n")

#: What texts do not contain, and what bytes that are no text are full of.
UNREADABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f\ufffd]+")

#: Where gzip, zlib, bz2, xz and zstd data (or a zstd frame to skip) may begin.
MAGIC = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)"
                   rb"|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|[\x50-\x5f]\x2a\x4d\x18")
MAGIC_BYTES = 10
DAMAGED = (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError) + (
    (zstandard.ZstdError,) if zstandard else ())
#: Compressed bytes read at a time.
CHUNK = 16_384

_HEX_RUN = bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_B64_RUN = bytes(1 if chr(i).isascii() and (chr(i).isalnum() or chr(i) in "+/-_") else 0
                 for i in range(256))
#: Characters of one decoded window, and what neighbouring windows share.
WINDOW_CHARS = 4_000_000
OVERLAP_CHARS = 100_000

FIELDS = T.StructType([
    T.StructField(name, T.StringType() if name in ("base_sha256", "spans") else T.LongType())
    for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans", "n_layers")])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of every match in one layer."""
    out = []
    low = text.lower()
    if any(k in low for k in KEY_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if b"\x01" * 16 in text.encode("utf-8", "surrogatepass").translate(_HEX_RUN):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class Layer:
    """A text and, for each of its characters, where it stands in the original.

    ``starts``/``ends`` are None when all characters come from the same span ``(lo, hi)``, and
    ``lo`` is None for the original itself.
    """

    __slots__ = ("text", "starts", "ends", "lo", "hi")

    def __init__(self, text, starts=None, ends=None, lo=None, hi=None):
        self.text, self.starts, self.ends, self.lo, self.hi = text, starts, ends, lo, hi

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is not None:
            return self.starts[start], self.ends[end - 1]
        return (start, end) if self.lo is None else (self.lo, self.hi)


def _escaped(m: re.Match) -> str | None:
    t = m[0]
    try:
        if t[0] == "&":
            code = int(t[3:-1], 16) if t[2] in "xX" else int(t[2:-1])
        elif len(t) == 12:
            code = 0x10000 + ((int(t[2:6], 16) & 0x3FF) << 10) + (int(t[8:], 16) & 0x3FF)
        else:
            code = int(t[2:].strip("{}"), 16)
        return None if 0xD800 <= code < 0xE000 or not code else chr(code)
    except (ValueError, OverflowError):
        return None


def _unpercent(m: re.Match) -> str | None:
    try:
        return unquote_to_bytes(m[0]).decode()
    except UnicodeDecodeError:
        return None


def _in_place(layer: Layer, pattern: re.Pattern, decode) -> Iterator[Layer]:
    """The layer with all matches of pattern decoded where they stand."""
    parts, starts, ends, at = [], [], [], 0
    whole = layer.lo is not None and layer.starts is None

    def keep(lo: int, hi: int) -> None:
        parts.append(layer.text[lo:hi])
        if not whole:
            starts.extend(range(lo, hi) if layer.starts is None else layer.starts[lo:hi])
            ends.extend(range(lo + 1, hi + 1) if layer.ends is None else layer.ends[lo:hi])

    for m in pattern.finditer(layer.text):
        new = decode(m)
        if new is None:
            continue
        keep(at, m.start())
        parts.append(new)
        if not whole:
            lo, hi = layer.place(m.start(), m.end())
            starts.extend([lo] * len(new))
            ends.extend([hi] * len(new))
        at = m.end()
    if at:
        keep(at, len(layer.text))
        text = "".join(parts)
        yield Layer(text, None, None, layer.lo, layer.hi) if whole else Layer(text, starts, ends)


class _Reader:
    """Reads pieces as one stream; what was not used can be put back."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces, self.held, self.at = iter(pieces), [], 0
        #: Where the last whole member ended.
        self.done = 0

    def read(self, n: int) -> bytes:
        while not self.held:
            piece = next(self.pieces, None)
            if piece is None:
                return b""
            self.back(piece)
            self.at += len(piece)
        out = self.held.pop()
        if len(out) > n:
            self.held.append(out[n:])
        self.at += min(n, len(out))
        return bytes(out[:n])

    def back(self, data: bytes) -> None:
        if data:
            self.held.append(memoryview(data))
            self.at -= len(data)

    def full(self, n: int) -> bytes:
        parts = []
        while n and (data := self.read(n)):
            parts.append(data)
            n -= len(data)
        return b"".join(parts)

    def skip(self, n: int) -> _Reader:
        while n and (data := self.read(min(n, WINDOW_CHARS))):
            n -= len(data)
        return self

    def head(self, n: int) -> bytes:
        out = self.full(n)
        self.back(out)
        return out


def _opened(head: bytes):
    """A decompressor for data that begins like this, or None."""
    if not MAGIC.match(head):
        return None
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"x":
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:2] == b"\xfd7":
        return lzma.LZMADecompressor()
    return zstandard and zstandard.ZstdDecompressor().decompressobj()


def _begins(sample: bytes) -> bool:
    """Whether compressed data really begins here, as far as the sample tells."""
    one = _opened(sample)
    try:
        if one is not None:
            one.decompress(sample, *([1000] if _limited(one) else []))
    except DAMAGED:
        return False
    return one is not None


def _limited(one) -> bool:
    """Whether it takes a limit of its output; zstandard's does not."""
    return "Zstd" not in type(one).__name__


def _members(read: _Reader) -> Iterator[bytes]:
    """Decompressed pieces of bounded size of all members that follow each other.

    There may be zeros between members. What is damaged further on is left out.
    """
    try:
        while (one := _opened(read.head(MAGIC_BYTES))) is not None:
            # zstd knows no limit of its output, but a byte yields 32 KB at most
            size, limit = (CHUNK, [WINDOW_CHARS]) if _limited(one) else (128, [])
            rest, more = b"", False
            while not one.eof:
                data = rest or (b"" if more else read.read(size))
                out = one.decompress(data, *limit)
                if out:
                    yield out
                elif not data:
                    if not more:
                        return  # cut off
                    more = False
                    continue
                rest = getattr(one, "unconsumed_tail", b"")
                more = not getattr(one, "needs_input", not limit or len(out) < limit[0])
            read.back(one.unused_data)
            read.done = read.at
            while (head := read.head(CHUNK)) and head[0] == 0:
                read.skip(len(head) - len(head.lstrip(b"\0")))
    except DAMAGED:
        return


def _windows(pieces: Iterable[bytes]) -> Generator[str, None, tuple]:
    """Bytes as overlapping texts.

    Returns a digest of all, all bytes if they fit in one window (else None), and the places where
    compressed data begins.
    """
    read, mark, starts, last, whole = _Reader(pieces), hashlib.blake2b(digest_size=16), [], -1, b""
    while piece := read.full(WINDOW_CHARS):
        mark.update(piece)
        whole = whole[-OVERLAP_CHARS:] + piece
        at = read.at - len(whole)
        for m in MAGIC.finditer(whole):
            if at + m.start() > last:
                last = at + m.start()
                if _begins(whole[m.start():m.start() + 512]):
                    starts.append(last)
        yield whole.decode(errors="replace")
    return mark.digest(), whole if read.at == len(whole) else None, starts


def _texts(data: bytes) -> Iterator[str]:
    """All that decoded bytes hold: as they are, and unpacked wherever compressed data begins.

    A level of nested data that does not fit in a window is not kept but read again, through all
    decompressors above it. One whose content was seen before is not unpacked again.
    """
    mark, _, starts = yield from _windows([data])
    seen, work = {mark}, [(lambda: [data], starts)]
    while work:
        again, starts = work[-1]
        if not starts:
            work.pop()
            continue
        start = starts.pop(0)
        read = _Reader(again()).skip(start)
        mark, whole, inner = yield from _windows(_members(read))
        del starts[:bisect.bisect_left(starts, read.done)]
        if inner and mark not in seen:
            work.append((partial(_inside, again, start) if whole is None
                         else partial(list, [whole]), inner))
        seen.add(mark)


def _inside(again, start: int) -> Iterator[bytes]:
    return _members(_Reader(again()).skip(start))


def _unbase64(layer: Layer) -> Iterator[Layer]:
    """Every run of base64 from each of its first four characters.

    What stands before a layer without a gap (a prefix, the last word of the line above) shifts it;
    from one of the four it is decoded right, after some bytes that mean nothing.
    """
    for m in BASE64.finditer(layer.text):
        run = m[0].translate(_STANDARD)
        if len(run) < MIN_BASE64:
            continue
        lo, hi = layer.place(m.start(), m.end())
        for first in range(4):
            end = len(run) - ((len(run) - first) % 4 == 1)
            data = base64.b64decode(run[first:end] + "=" * (-(end - first) % 4))
            for text in _texts(data):
                yield Layer(text, None, None, lo, hi)


def _below(layer: Layer) -> Iterator[Layer]:
    """The layers directly below one."""
    if "%" in layer.text:
        yield from _in_place(layer, PERCENT, _unpercent)
    if "\\" in layer.text or "&#" in layer.text:
        yield from _in_place(layer, ESCAPE, _escaped)
    raw = layer.text.encode("utf-8", "surrogatepass")
    if b"\x01" * MIN_BASE64 in raw.translate(_B64_RUN, b" \t\r\n" if b"\n" in raw else b""):
        yield from _unbase64(layer)


def layers(text: str) -> Iterator[Layer]:
    """Every layer below the original text, each once per place."""
    top = Layer(text)
    work, seen = [(top, _below(top))], set()
    while work:
        layer, below = work[-1]
        new = next(below, None)
        if new is None:
            work.pop()
            continue
        mark = (hashlib.blake2b(new.text.encode("utf-8", "surrogatepass"), digest_size=16)
                .digest(), new.lo, new.hi)
        if mark not in seen and (new.text != layer.text or new.lo != layer.lo):
            seen.add(mark)
            yield new
            work.append((new, _below(new)))


def all_spans(text: str) -> tuple[list, list, int]:
    """Base spans, all spans, number of layers below the text.

    Every decoded layer is scanned; those that are no text and hold no span are not counted.
    """
    base = base_spans(text)
    spans, n = set(base), 0
    for layer in layers(text):
        found = base_spans(layer.text)
        n += bool(found) or len(UNREADABLE.sub("", layer.text)) >= 0.95 * len(layer.text)
        for start, kind, end in found:
            lo, hi = layer.place(start, end)
            spans.add((lo, kind, hi))
    return base, sorted(spans), n


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


@F.pandas_udf(FIELDS)
def _scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        base, spans, n = all_spans(text) if text else ([], [], 0)
        kinds = [k for _, k, _ in base]
        rows.append((kinds.count(0), kinds.count(1), kinds.count(2),
                     hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans),
                     len(spans), n))
    return pd.DataFrame(rows, columns=FIELDS.names)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and the fields of ``FIELDS``."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", _scan(F.col("text")).alias("s")).select("doc_id", "s.*")


MASK = "[SECRET]"


@F.pandas_udf(T.StringType())
def masked(texts: pd.Series) -> pd.Series:
    """Texts with every span, and whatever encloses it, replaced."""
    out = []
    for text in texts:
        spans = all_spans(text)[1] if text else []
        parts, at = [], 0
        for start, _, end in spans:
            if start >= at:
                parts += (text[at:start], MASK)
            at = max(at, end)
        out.append(text if not spans else "".join(parts) + text[at:])
    return pd.Series(out, dtype=object)


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with their secrets masked; the number of characters follows the text."""
    small_batches(docs.sparkSession)
    new: Column = masked(F.col(text))
    out = docs.withColumn(text, new)
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        out = out.withColumn(n_chars, F.when(F.col(text).isNull(), F.col(n_chars))
                             .otherwise(F.char_length(F.col(text))).cast(kind))
    return out
