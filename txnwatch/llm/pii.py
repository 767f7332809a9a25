"""Personal data: fixed patterns, plus spans of a character-level BiLSTM-CRF that finds what is written around them.

The network learns from windows of a bounded sample of documents: windows with the patterns' matches, the same surroundings
with the match rewritten as people write it past a pattern (``rewrite``: a spelled or bracketed at sign and dot, a spaced or
bracketed address, a phone number without its plus sign, a card number in other groups), and windows without any, which teach
it what to leave alone. All of these hold a digit, an @ or the word "at" or "dot", so it reads the surroundings of these
only: the stretches around them are covered by windows that overlap by half, the windows' scores are averaged per
character, and one Viterbi pass over the whole stretch reconciles them. A found span that overlaps no pattern's span and
is possible for its kind (``possible``: a card number must pass its checksum, an address have four parts up to 255, an
e-mail read as one once its signs are put back) is added as kind ``lstm_...``. Names and street addresses are no kinds here.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm import lstm_crf
from txnwatch.llm.text import chunks

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
SPELLED = re.compile(r"\b(?:[Aa][Tt]|[Dd][Oo][Tt])\b")
#: How an at sign and a dot are written past the patterns, and how such spellings are read.
ATS = (" at ", " (at) ", "(at)", "[at]", " [at] ", " AT ", " @ ")
DOTS = (" dot ", " (dot) ", "(dot)", "[dot]", " [dot] ", " DOT ", " . ")
PART_DOTS = ("[.]", " . ", "(.)", "[dot]", " dot ")
READ_AT = re.compile(r"\s*[\[({]\s*(?:at|@)\s*[\])}]\s*|\s+at\s+|\s*@\s*", re.I)
READ_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+|\s\.\s", re.I)
#: Tags: 0 outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Characters of a window, its step, and the characters read on either side of a digit, an @ or a spelled sign.
WINDOW, STEP, AROUND = 96, 48, 32
#: The sample the network is fitted on: at most so many windows with matches, so many with rewritten ones and so many
#: without; its steps; and the ways in which a match is rewritten.
SAMPLE, STEPS, WAYS = 1200, 360, 4


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns by kind and start: per kind leftmost, non-overlapping matches that pass.
    E-mails are found from their @ and addresses from their dotted chain, in linear time on any text."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        floor = found.end() if found else at + 1
        if found:
            out.append((0, start, floor))
        at = text.find("@", floor)
    if TRIGGER.search(text) is None:
        return out
    for m in CHAIN.finditer(text):
        if text.find(".", m.start(), m.end()) >= 0:
            parts, at = m[0].split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                end = at + sum(map(len, parts[i:i + 4])) + 3
                if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in parts[i:i + 4]):
                    out.append((1, at, end))
                at = end + 1
    for kind, pattern, fits in ((2, CARD, lambda d: 16 <= len(d) <= 19 and luhn(d)), (3, PHONE, lambda d: 8 <= len(d) <= 15)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= 8 and fits("".join(c for c in m[0] if "0" <= c <= "9")):
                out.append((kind, m.start(), m.end()))
    return out


def rewrite(kind: int, found: str, way: int) -> str:
    """A pattern's match written past the pattern; ``way`` (any number) chooses among the ways."""
    if kind == 0:
        local, domain = found.rsplit("@", 1)
        at, dot = ATS[way % len(ATS)], DOTS[way // len(ATS) % len(DOTS)]
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return found.replace(".", PART_DOTS[way % len(PART_DOTS)])
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == 2:
        return (".", "/", "_", " - ")[way % 4].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    rest = found[1:]
    return "00" + rest if way % 2 or "(" not in rest else rest[rest.index("("):]


def possible(kind: int, found: str) -> bool:
    """Whether a string can be personal data of the kind, once spelled signs are read."""
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == 0:
        read = READ_AT.sub("@", READ_DOT.sub(".", found))
        return bool(re.fullmatch(r"[^@\s]+@[^@\s.]+(\.[^@\s.]+)*\.[^\W\d_]{2,}", read))
    if kind == 1:
        parts = READ_DOT.sub(".", found).split(".")
        return len(parts) == 4 and all(re.fullmatch("[0-9]{1,3}", p) and int(p) <= 255 for p in parts)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15 and (digits != found or found.startswith("00"))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point: its shape for letters and digits, itself for the signs that matter."""
    signs = " \n@.-+()_%/:,;=\"'#[]{}"
    out = np.zeros(0x110000, np.int8)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            out[c] = 1 if c < 128 and ch.islower() else 2 if c < 128 else 3
    out[48:58] = 4
    for i, ch in enumerate(signs):
        out[ord(ch)] = 5 + i
    for i, ch in enumerate("adot"):  # the letters of the spelled signs
        out[ord(ch)] = out[ord(ch.upper())] = 5 + len(signs) + i
    return out


CLASSES = 5 + 22 + 4


def codes(text: str) -> np.ndarray:
    return _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)


def stretches(text: str) -> list[tuple[int, int]]:
    """[start, end) around the digits, at signs and spelled signs of a text, merged where they touch."""
    out: list[list[int]] = []
    places = [m.start() for m in TRIGGER.finditer(text)]
    if spelled := [m.start() for m in SPELLED.finditer(text)]:
        places = sorted(places + spelled)
    for at in places:
        a, b = max(0, at - AROUND), min(len(text), at + 1 + AROUND)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows(start: int, end: int) -> list[int]:
    """Starts of the overlapping windows that cover a stretch."""
    return [start, *range(start + STEP, max(start + 1, end - WINDOW + STEP), STEP)] if end - start > WINDOW else [start]


def _padded(c: np.ndarray, at: int) -> np.ndarray:
    part = c[at:at + WINDOW]
    return np.r_[part, np.full(WINDOW - len(part), 5)] if len(part) < WINDOW else part  # blanks after the end


def rewritten(text: str, tags: np.ndarray, spans: list[tuple[int, int, int]]) -> Iterator[tuple[bytes, bytes]]:
    """Windows (classes, tags) with each match of a text rewritten in WAYS ways."""
    for kind, a, b in spans:
        left, right = max(0, a - AROUND), b + AROUND
        for way in range(WAYS):
            new = rewrite(kind, text[a:b], zlib.crc32(text[a:b].encode()) + way * 17)
            t = np.zeros(WINDOW, np.int8)
            whole = np.r_[tags[left:a], 1 + 2 * kind, np.full(len(new) - 1, 2 + 2 * kind), tags[b:right]][:WINDOW]
            t[:len(whole)] = whole
            yield _padded(codes(text[left:a] + new + text[b:right]), 0).astype(np.int8).tobytes(), t.tobytes()


def learn(df: DataFrame, text_col: str = "text", sample: int = SAMPLE, steps: int = STEPS) -> dict[str, np.ndarray] | None:
    """The network, or None where the texts hold no labelled span. The sample is drawn by a hash of the windows' own
    content, so it does not depend on the order of the rows; it is bounded by 3 * ``sample`` windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "t"):
                rows = []
                for text in part.column(0).to_pylist():
                    places = stretches(text)
                    if not places:
                        continue
                    c, tags = codes(text), np.zeros(len(text) + WINDOW, np.int8)
                    spans = pattern_spans(text)
                    for kind, a, b in reversed(spans):
                        tags[a:b] = 2 + 2 * kind
                        tags[a] = 1 + 2 * kind
                    for a, b in places:
                        for at in windows(a, b):
                            y = tags[at:at + WINDOW]
                            rows.append((_padded(c, at).astype(np.int8).tobytes(), y.tobytes(), int(y.any())))
                    rows += [(x, y, 2) for x, y in rewritten(text, tags, spans)]
                x, y, sort = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary()), pa.array(sort, pa.int32())],
                                                 names=["x", "y", "sort"])

    found = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("t")).mapInArrow(run, "x binary, y binary, sort int")
    # repeated windows teach nothing new
    found = found.groupBy("x").agg(F.max(F.struct("sort", "y")).alias("m")).select("x", "m.y", "m.sort", F.xxhash64("x").alias("h"))
    # three bounded samples of one pass: the smallest hashes of each sort
    picked = [found.where(F.col("sort") == k).orderBy("h", "x").limit(sample) for k in range(3)]
    rows = sorted((bytes(r["x"]), bytes(r["y"]), r["sort"]) for r in picked[0].unionByName(picked[1]).unionByName(picked[2]).collect())
    if not any(r[2] for r in rows):
        return None
    x = np.stack([np.frombuffer(r[0], np.int8) for r in rows]).astype(np.int64)
    y = np.stack([np.frombuffer(r[1], np.int8) for r in rows]).astype(np.int64)
    return lstm_crf.fit(x, y, CLASSES, TAGS, steps)


def model_spans(model: dict[str, np.ndarray], texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """The spans that the network adds to each text's ``base``, kinds numbered from len(KINDS) on."""
    jobs, batch = [], []
    for i, text in enumerate(texts):
        places = stretches(text)
        c = codes(text) if places else None
        for a, b in places:
            starts = windows(a, b)
            jobs.append((i, a, b, len(batch), starts))
            batch += [_padded(c, at) for at in starts]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not jobs:
        return out
    scores = np.concatenate([lstm_crf.emissions(model, np.stack(batch[k:k + 512])) for k in range(0, len(batch), 512)])
    averaged = []
    for _, a, b, first, starts in jobs:
        total, seen = np.zeros((b - a, TAGS)), np.zeros((b - a, 1))
        for k, at in enumerate(starts):
            n = min(WINDOW, b - at)
            total[at - a:at - a + n] += scores[first + k, :n]
            seen[at - a:at - a + n] += 1
        averaged.append(total / np.maximum(seen, 1))
    for (i, a, *_), tags in zip(jobs, lstm_crf.paths(model, averaged), strict=True):
        t = 0
        while t < len(tags):
            if tags[t]:
                kind, s = (int(tags[t]) - 1) // 2, t
                t += 1
                while t < len(tags) and tags[t] == 2 + 2 * kind:
                    t += 1
                start, end = a + s, a + t
                while start < end and texts[i][start].isspace():
                    start += 1
                while start < end and texts[i][end - 1].isspace():
                    end -= 1
                if possible(kind, texts[i][start:end]) and not any(x < end and start < y for _, x, y in base[i]):
                    out[i].append((len(KINDS) + kind, start, end))
            else:
                t += 1
    return [sorted(x) for x in out]


def name(kind: int) -> str:
    return KINDS[kind] if kind < len(KINDS) else f"lstm_{KINDS[kind - len(KINDS)]}"


def _found(model, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    base = [pattern_spans(t) for t in texts]
    more = model_spans(model, texts, base) if model else [[] for _ in texts]
    return [sorted(b) + m for b, m in zip(base, more, strict=True)]


def find(df: DataFrame, model: dict[str, np.ndarray] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) per row, in code points, by kind (patterns first), then start.

    Null text counts as empty; repeated rows and null ids stay; other columns are not read; an empty table gives an empty
    one. Long texts are read in stretches, never cut.
    """
    kind = dict(df.dtypes)[id_col]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                found = _found(model, [t or "" for t in part.column(1).to_pylist()])
                rows = [[{"kind": name(k), "start": a, "end": b} for k, a, b in f] for f in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, span)], names=[id_col, "spans"])

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind string, start bigint, `end` bigint>>")


def redact(df: DataFrame, model: dict[str, np.ndarray] | None, text_col: str = "text") -> DataFrame:
    """``df``, all columns, with every span of its texts replaced by its kind in square brackets; overlapping spans become
    one, named after the first. Null text stays null."""
    def cover(text: str, spans: list[tuple[int, int, int]]) -> str:
        out, at, until = [], 0, 0
        for k, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
            if a >= until:
                out += [text[at:a] if a > at else "", f"[{name(k).removeprefix('lstm_').upper()}]"]
            at = until = max(until, b)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text_col):
                at = part.schema.get_field_index(text_col)
                texts = part.column(at).to_pylist()
                found = _found(model, [t or "" for t in texts])
                texts = [cover(t, f) if f else t for t, f in zip(texts, found, strict=True)]
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.column(at).type))

    return df.mapInArrow(run, df.schema)
