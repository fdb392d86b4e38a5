"""Secret scans: fixed patterns, and a token-efficiency test for the rest.

The base patterns find assignments, access keys and long hexadecimal strings.
The method adds strings that a public tokenizer can hardly compress: ordinary
words and names take few tokens for their length, random strings many. A
candidate is a run of at least ``MIN_RANDOM`` key characters; known digests,
UUIDs, numbers and identifiers built from words are left out, and of the others
those with at most ``MAX_CHARS_PER_TOKEN`` characters a token are secrets of kind
``random``. So that words joined to a key don't hide it, a run that is none as a
whole is looked at in parts: what base spans leave of it, what is left between its
ordinary words, and its
alphanumeric pieces, which are secrets if any ``MIN_RANDOM`` characters of
theirs are. Letters alone are judged like any other string.

One ``mapInArrow`` pass over whole texts, no shuffle; positions are code
points, ends exclusive.

Defined cases: a null text counts as empty (no spans). Repeated rows give
repeated results; an empty table gives an empty one; other columns of the input
are not looked at.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.tables import columns_of

# The base patterns, letters of ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")

MIN_RANDOM = 20
MAX_CHARS_PER_TOKEN = 2.0
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.IGNORECASE)
UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.IGNORECASE)
# Words and numbers joined by separators, or capitalised words run together.
_PART = r"(?:[a-z]+|[A-Z]+|[A-Z][a-z]+|[0-9]+)"
IDENTIFIER = re.compile(
    rf"[0-9]+|(.)\1+|(?=[A-Za-z0-9]*[_/=+-])[_/=+-]*+(?:{_PART}(?:[_/=+-]++|$))*+|(?:[a-z]{{2,}})?(?:[A-Z][a-z]{{2,}})+[0-9]{{0,4}}"
)
PIECE = re.compile(r"[A-Za-z0-9]+")
WORD = re.compile(_PART)

SPANS = "array<struct<kind: string, start: long, end: long>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind as listed, end) of the base patterns."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if any(len(w) >= MIN_HEX for w in text.split()):
        found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return found


def looks_random(s: str, enc: tiktoken.Encoding, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    if DIGEST.fullmatch(s) or UUID.fullmatch(s) or IDENTIFIER.fullmatch(s):
        return False
    return len(s) <= most * len(enc.encode_ordinary(s))


def holds_random(s: str, enc: tiktoken.Encoding, most: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Whether some tokens in a row of a piece have ``MIN_RANDOM`` characters or
    more, and at most ``most`` characters each on average."""
    if DIGEST.fullmatch(s) or IDENTIFIER.fullmatch(s):
        return False
    ends, spare = [0], [0.0]
    for t in enc.encode_ordinary(s):
        n = len(enc.decode_single_token_bytes(t))
        ends.append(ends[-1] + n)
        spare.append(spare[-1] + most - n)
    least, k = math.inf, 0
    for end, value in zip(ends, spare, strict=True):
        while ends[k] <= end - MIN_RANDOM:
            least = min(least, spare[k])
            k += 1
        if value >= least:
            return True
    return False


def random_parts(s: str, enc: tiktoken.Encoding) -> list[tuple[int, int]]:
    """(start, end) of the secrets in a run of key characters."""
    if looks_random(s, enc):
        return [(0, len(s))]
    if DIGEST.fullmatch(s) or UUID.fullmatch(s):
        return []
    pieces = [(m.start(), m.end()) for m in PIECE.finditer(s)]
    found: list[tuple[int, int]] = []
    core: list[tuple[int, int]] = []
    for a, b in [*pieces, (len(s), len(s))]:
        # A number or an ordinary word ends what may be one key.
        if b > a and not (WORD.fullmatch(s, a, b) and (s[a:b].isdigit() or b - a > MAX_CHARS_PER_TOKEN * len(enc.encode_ordinary(s[a:b])))):
            core.append((a, b))
            continue
        if core and len(core) < len(pieces) and (whole := (core[0][0], core[-1][1]))[1] - whole[0] >= MIN_RANDOM and looks_random(s[slice(*whole)], enc):
            found.append(whole)
        core = []
    for a, b in pieces:
        if b - a >= MIN_RANDOM and not any(x <= a and b <= y for x, y in found) and holds_random(s[a:b], enc):
            found.append((a, b))
    return sorted(found)


def _left_over(start: int, end: int, held: list[tuple[int, int]], k: int) -> Iterator[tuple[int, int]]:
    """What the spans ``held``, sorted by start, leave of a run of key characters;
    those before the ``k``-th end before it."""
    while k < len(held) and held[k][0] < end:
        if held[k][0] > start:
            yield start, held[k][0]
        start = max(start, held[k][1])
        k += 1
    if start < end:
        yield start, end


def spans_of(text: str, enc: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    found = base_spans(text)
    if any(len(w) >= MIN_RANDOM for w in text.split()):
        held = sorted((a, b) for a, _, b in found)
        k = 0
        for m in CANDIDATE.finditer(text):
            while k < len(held) and held[k][1] <= m.start():
                k += 1
            for start, end in _left_over(m.start(), m.end(), held, k):
                if end - start >= MIN_RANDOM:
                    found += [(start + a, 3, start + b) for a, b in random_parts(text[start:end], enc)]
    return sorted(found)


def _mapped(docs: DataFrame, column: str, kind: pa.DataType, ddl: str, text: str, make: Callable) -> DataFrame:
    """``docs`` with ``column`` replaced or added by ``make(text)`` for each row."""
    null_stays = column == text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = pa.array([None if t is None and null_stays else make(t or "") for t in texts], type=kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["row", "made"])

    # The row travels as one struct, so no name of its columns can be in the way.
    source = docs.select(F.struct(*columns_of(docs)).alias("row"), F.col(f"`{text}`").alias("made"))
    schema = source.select("row", F.lit(None).cast(ddl).alias("made")).schema
    names = docs.columns if column in docs.columns else [*docs.columns, column]
    out = [F.col("made").alias(c) if c == column else F.col("row").getField(c).alias(c) for c in names]
    return source.mapInArrow(run, schema).select(*out)


def find_secrets(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``, the secrets of each text by start and kind."""

    def make(t: str) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t, tokenizer(path, pattern))]

    return _mapped(docs, "spans", _SPANS_ARROW, SPANS, text, make)


def redact(docs: DataFrame, path: str, pattern: str, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark`` (overlapping
    spans by one mark); null texts stay null, columns and their order too."""

    def make(t: str) -> str:
        out, end = [], 0
        for a, _, b in spans_of(t, tokenizer(path, pattern)):
            if a >= end:
                out += [t[end:a], mark]
            end = max(end, b)
        return "".join([*out, t[end:]])

    return _mapped(docs, text, pa.string(), "string", text, make)


def span_list(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the given kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(list(kinds)))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
