"""Secrets in texts and in what texts hold encoded: assigned values, access key ids and long hexadecimal strings.

A worklist of layers starts with the text. Each layer is searched for the three kinds; then what is encoded in it makes
further layers, until there are none:

* escapes (URL `%41`, Unicode `\\u0041`, `\\u{41}`, `\\U00000041`, `\\x41`, references `&#65;`) are undone a level at a time in
  each line that has some. No kind goes over a line, and a line keeps what stands beside the escapes. Nesting beyond LEVELS
  levels is undone in one pass by a stack, so that a row takes linear time;
* runs of base64 (plain or URL-safe, also over lines, at each of four alignments, as a run may begin inside a path) are
  decoded; stretches of printable ASCII are layers, for no kind has other characters;
* compressed streams (gzip, zlib, bzip2, xz) in decoded bytes are expanded piece by piece, cut where no kind can go on.

A layer whose bytes are those of one it came from is a cycle and is not followed (streams are told by their first piece).
Each layer knows where its characters stand in the one before, so a find is a span of the text: the escapes or
the base64 characters it was decoded from, the whole run for compressed data.

Spans found in the text itself have no `via`; a span found again in a decoded layer is kept once, with the shortest way.

Nulls and edge cases: a null text is the empty text and has no spans. Each row is scanned on its own: repeated rows and null ids
give a row each, an empty table gives none. Whole texts are scanned whatever their length. Other columns are not read.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_left, bisect_right
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import col, text_of

# The kinds in their order, and their forms.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
NAMES = ("password", "passwd", "secret", "token", "api")
VALUE_LENGTH, ACCESS_LENGTH = 8, 16

ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}|\\(?:u[0-9A-Fa-f]{4}|u\{[0-9A-Fa-f]{1,6}\}|U[0-9A-Fa-f]{8}|x[0-9A-Fa-f]{2})|&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});")
# The shortest secret, `token=` and eight characters, takes 19 characters of base64.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}(?:\r?\n[A-Za-z0-9+/_-]{4,})*")
PRINTABLE = re.compile(rb"[\x20-\x7e]{14,}")
STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
LEVELS = 16
PIECE = 1 << 22
IN_RUN = np.zeros(256, bool)
IN_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-\r")] = True


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of one layer, leftmost and not overlapping within a kind."""
    out, low = [], text.lower()
    if any(n in low for n in NAMES):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= VALUE_LENGTH]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


class Layer:
    """A text and where it comes from."""

    def __init__(self, text: str, parent: Layer | None = None, via: str = "", digest: bytes = b""):
        self.text, self.parent, self.depth = text, parent, parent.depth + 1 if parent else 0
        self.via = f"{parent.via}>{via}" if parent and parent.via else via
        self.digest = digest or hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=16).digest()

    def origin(self, start: int, end: int) -> tuple[int, int]:
        return start, end

    def root_span(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.parent is not None:
            start, end = layer.origin(start, end)
            layer = layer.parent
        return start, end

    def changed(self, start: int, end: int) -> bool:
        """Whether a stretch stands otherwise in the layer before."""
        return True

    def is_cycle(self) -> bool:
        layer = self.parent
        while layer is not None:
            if layer.digest == self.digest:
                return True
            layer = layer.parent
        return False


class Unescaped(Layer):
    """A line of the parent without its escapes: decoded characters stand `at` places and come from [starts, ends)."""

    def __init__(self, text, parent, line_start, at, starts, ends, levels=1):
        super().__init__(text, parent, "escapes")
        self.line_start, self.at, self.starts, self.ends = line_start, at, starts, ends
        self.levels = levels

    def origin(self, start, end):
        i = bisect_right(self.at, start) - 1
        first = self.line_start + start if i < 0 else self.starts[i] if self.at[i] == start else self.ends[i] + start - self.at[i] - 1
        i = bisect_right(self.at, end - 1) - 1
        last = self.line_start + end if i < 0 else self.ends[i] if self.at[i] == end - 1 else self.ends[i] + end - 1 - self.at[i]
        return first, last

    def changed(self, start, end):
        i = bisect_left(self.at, start - 1)
        return i < len(self.at) and self.at[i] <= end


class Decoded(Layer):
    """Printable bytes from the one at `offset` on, decoded from base64 characters that stand at `places` of the parent."""

    def __init__(self, text, parent, places, offset):
        super().__init__(text, parent, "base64")
        self.places, self.offset = places, offset

    def origin(self, start, end):
        bit, last = (self.offset + start) * 8, (self.offset + end) * 8 - 1
        return int(self.places[bit // 6]), int(self.places[last // 6]) + 1


class Expanded(Layer):
    """A piece of a stream; all of it comes from one span of the parent."""

    def __init__(self, text, parent, span, via, digest=b""):
        super().__init__(text, parent, via, digest)
        self.span = span

    def origin(self, start, end):
        return self.span


def character(escape: str) -> str:
    """The character of an escape; what is not ASCII cannot be part of a secret and counts as unknown."""
    digits = escape.strip("%\\&#;{}uUxX")
    code = int(digits, 10 if escape[0] == "&" and escape[2] not in "xX" else 16)
    return chr(code) if code < 128 else "�"


def unescaped_once(line: str, start: int, parent: Layer, levels: int) -> Unescaped:
    parts, at, starts, ends, size, last = [], [], [], [], 0, 0
    for m in ESCAPE.finditer(line):
        parts += [line[last:m.start()], character(m.group())]
        size += m.start() - last
        at.append(size)
        starts.append(start + m.start())
        ends.append(start + m.end())
        size, last = size + 1, m.end()
    parts.append(line[last:])
    return Unescaped("".join(parts), parent, start, at, starts, ends, levels)


def unescaped_wholly(line: str, start: int, parent: Layer) -> Unescaped:
    """All levels at once: a character decoded is looked at again with those before it."""
    text, starts, ends = [], [], []
    for i, c in enumerate(line):
        text.append(c)
        starts.append(start + i)
        ends.append(start + i + 1)
        while text[-1] in "0123456789abcdefABCDEF};":
            tail = "".join(text[-12:])
            m = next((m for m in ESCAPE.finditer(tail) if m.end() == len(tail)), None)
            if m is None:
                break
            n = len(m.group())
            text[-n:], starts[-n:], ends[-n:] = [character(m.group())], [starts[-n]], [ends[-1]]
    at = [i for i in range(len(text)) if ends[i] - starts[i] > 1]
    return Unescaped("".join(text), parent, start, at, [starts[i] for i in at], [ends[i] for i in at], LEVELS + 1)


def escaped_lines(layer: Layer):
    """A layer for each line that holds escapes."""
    text, end = layer.text, -1
    if not ("%" in text or "\\" in text or "&#" in text):
        return
    levels = layer.levels + 1 if isinstance(layer, Unescaped) else 1
    for m in ESCAPE.finditer(text):
        if m.start() < end:
            continue
        start = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.start())
        end = len(text) if end < 0 else end
        line = text[start:end]
        yield unescaped_once(line, start, layer, levels) if levels <= LEVELS else unescaped_wholly(line, start, layer)


def expander(head: bytes):
    """The name of a stream's form and what expands it."""
    if head[:1] == b"\x1f":
        return "gzip", zlib.decompressobj(31)
    if head[:1] == b"x":
        return "zlib", zlib.decompressobj(15)
    if head[:1] == b"B":
        return "bzip2", bz2.BZ2Decompressor()
    return "xz", lzma.LZMADecompressor()


def expanded(chunks, machine):
    """The content of a stream, in chunks of bounded size; what comes before a fault or the end counts."""
    try:
        for chunk in chunks:
            if isinstance(machine, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
                out = machine.decompress(chunk, PIECE)
                while out or not (machine.needs_input or machine.eof):
                    yield out
                    out = b"" if machine.eof else machine.decompress(b"", PIECE)
            else:
                out = machine.decompress(chunk, PIECE)
                while out:
                    yield out
                    out = machine.decompress(machine.unconsumed_tail, PIECE)
            if machine.eof:
                return
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return


def blocks(chunks):
    """Bytes in pieces, cut where neither a kind nor a run of base64 goes on: at a byte that is not printable, or at a line's end after a sign."""
    held, looked = bytearray(), 0
    for chunk in chunks:
        held += chunk
        if len(held) < PIECE:
            continue
        new = np.frombuffer(bytes(held[looked:]), np.uint8)
        cuts = ((new < 32) | (new > 126)) & (new != 10) & (new != 13)
        cuts[1:] |= (new[1:] == 10) & ~IN_RUN[new[:-1]]
        at = np.flatnonzero(cuts)
        looked = len(held)
        if len(at):
            cut = looked - len(new) + int(at[-1]) + 1
            yield bytes(held[:cut])
            held, looked = held[cut:], looked - cut
    if held:
        yield bytes(held)


def stream_layers(data: memoryview, parent: Layer, span: tuple[int, int]):
    """Layers of a compressed stream at the start of data; streams in streams are expanded in turn."""
    name, machine = expander(bytes(data[:8]))
    via, seen, chunks = name, set(), expanded(iter([data]), machine)
    while True:
        first = next(chunks, b"")
        digest = hashlib.blake2b(first, digest_size=16).digest()
        if not first or digest in seen:
            return
        seen.add(digest)
        rest = _joined(first, chunks)
        if not STREAM.match(first):
            break
        name, machine = expander(first[:8])
        via, chunks = f"{via}>{name}", expanded(rest, machine)
    for block in blocks(rest):
        layer = Expanded(block.decode("latin-1"), parent, span, via)
        if not layer.is_cycle():
            yield layer


def _joined(first, rest):
    yield first
    yield from rest


def encoded_runs(layer: Layer):
    """Layers of what base64 runs hold."""
    for m in BASE64.finditer(layer.text):
        if not layer.changed(m.start(), m.end()):
            continue
        run = m.group()
        if "\n" not in run:
            yield from decoded_run(run, range(m.start(), m.end()), layer)
            continue
        places = m.start() + np.flatnonzero(~np.isin(np.frombuffer(run.encode(), np.uint8), (10, 13)))
        yield from decoded_run(run.replace("\r", "").replace("\n", ""), places, layer)
        for line in re.finditer(r"[^\r\n]{19,}", run):  # a line may be a run of its own
            start = m.start() + line.start()
            yield from decoded_run(line.group(), range(start, start + len(line.group())), layer, streams_only=True)


def decoded_run(run: str, places, layer: Layer, streams_only: bool = False):
    run = run.replace("-", "+").replace("_", "/").encode()
    for shift in range(4):
        part = run[shift:]
        part = part[:len(part) - (len(part) % 4 == 1)]
        data = binascii.a2b_base64(part + b"=" * (-len(part) % 4))
        for m in STREAM.finditer(data):
            first = shift + m.start() * 8 // 6
            yield from stream_layers(memoryview(data)[m.start():], layer, (int(places[first]), int(places[-1]) + 1))
        if streams_only:
            continue
        for m in PRINTABLE.finditer(data):
            found = Decoded(m.group().decode(), layer, places[shift:], m.start())
            if not found.is_cycle():
                yield found


def secret_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, via) of all layers, by start, kind and end."""
    found, seen, work = {}, set(), [iter([Layer(text)])]  # children are made when their turn comes
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = (layer.digest, layer.root_span(0, len(layer.text)))
        if key in seen:
            continue
        seen.add(key)
        for kind, start, end in base_spans(layer.text):
            span = (kind, *layer.root_span(start, end))
            if span not in found or layer.depth < found[span][0]:
                found[span] = (layer.depth, layer.via)
        work.append(chain(escaped_lines(layer), encoded_runs(layer)))
    order = sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [(*s, found[s][1]) for s in order]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end, via) of each document."""
    source = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("data"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("via", pa.string())])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                found = [[dict(zip(("kind", "start", "end", "via"), s)) for s in secret_spans(t.as_py())] for t in rows.column(1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.list_(span))], names=["doc_id", "spans"])

    schema = source.select("doc_id").schema.add("spans", source.select(F.lit(None).cast("array<struct<kind:string,start:long,end:long,via:string>>")).schema[0].dataType)
    return source.mapInArrow(run, schema)


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
