"""Secret scan: fixed patterns, and values in credential contexts judged by guess cost.

The guess cost of a value is the least cost, over all ways to cut it into
consecutive spans, of the product of the spans' guesses: dictionary words (by
their rank), dates, repeats, alphabetic or digit sequences, walks on a keyboard,
and brute force for the rest. It is found by dynamic programming over the end of
the last span, in log10; a run can be cut anywhere, so every part of it that is
long enough is a span too. A value that even its cheapest reading makes expensive
is taken for a secret; "password: changeme123" is not.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meterlake.llm.shared import OUT_BYTES, narrow, texts

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "guess")

#: Cheap tests before the patterns run.
_ASSIGN_HINT = re.compile(r"[:=]")
# A wider credential context for the guess cost: key word, separator, then a value
# without white space or quotes.
CONTEXT = re.compile(
    r"""(?:passwords?|passwd|passphrase|passcode|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?|auth)["']?[ \t]*(?:[:=]|=>|:=)[ \t]*["']?([^\s"'<>,;]{6,})""",
    re.IGNORECASE | re.ASCII,
)
#: Least log10 of guesses for a value to be a secret.
LEAST_GUESSES = 9.0

# Common words of passwords and placeholders, commonest first.
COMMON = (
    "password 123456 qwerty admin welcome login letmein user test guest root changeme secret token default "
    "example sample your here none null true false value string key pass word enter master monkey dragon "
    "football baseball shadow sunshine princess hello freedom whatever trustno trust super batman love "
    "summer winter spring autumn january february march april may june july august september october "
    "november december monday tuesday friday sunday company service server database system access auth "
    "the and for with that this from have not are new old my the api app web dev prod stage local host"
).split()
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4301$5@7!", "aeoissati")

#: Lengths of a date; of a year alone the first.
_DATE_LENGTHS = (4, 6, 7, 8, 9, 10)
_DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")


def _neighbours() -> set[tuple[str, str]]:
    at = {c: (x + y / 2, y) for y, row in enumerate(KEY_ROWS) for x, c in enumerate(row)}
    return {(a, b) for a, (x, y) in at.items() for b, (u, v) in at.items() if a != b and abs(x - u) <= 1 and abs(y - v) <= 1}


NEIGHBOURS = _neighbours()
RANKS = {w: i + 1 for i, w in reversed([*enumerate(COMMON)])}
_LONGEST = max(map(len, RANKS))
#: Longest block whose repeats are a span.
LONGEST_BLOCK = 8


def _alphabet(value: str) -> int:
    """Characters that a brute-force search over the value's classes would try."""
    return max(
        10,
        26 * any("a" <= c <= "z" for c in value)
        + 26 * any("A" <= c <= "Z" for c in value)
        + 10 * any("0" <= c <= "9" for c in value)
        + 33 * any(not c.isalnum() for c in value)
        + 100 * any(c.isalnum() and not c.isascii() for c in value),
    )


def lowered(value: str) -> str:
    """The value in lower case, with as many characters."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in value)


def listed(value: str, words: dict[str, int]) -> Iterator[tuple[int, int, float, str]]:
    """(start, end, log10 guesses, kind) of each word and date of the value, overlapping ones too."""
    low, n = lowered(value), len(value)
    plain = low.translate(LEET)
    for i in range(n):
        for j in range(i + 3, min(n, i + _LONGEST) + 1):
            for text, extra in ((low, 0.0), (plain, math.log10(2))):
                if rank := words.get(text[i:j]):
                    case = 0.0 if value[i:j] == text[i:j] else math.log10(2)
                    yield i, j, math.log10(rank + 1) + extra + case, "word"
        if "0" <= value[i] <= "9":
            for size in _DATE_LENGTHS:
                if i + size <= n and _DATE.fullmatch(value, i, i + size):
                    yield i, i + size, 4.6 if size > 4 else 2.1, "date"


class Runs:
    """Spans of one kind whose parts are spans too: at least ``least`` characters, a multiple of ``unit``.

    ``since[k]`` is the first character of the run that ends at k. A span costs
    ``base`` and the logarithm of its length in units.
    """

    def __init__(self, kind: str, unit: int, least: int, since: list[int], base):
        self.kind, self.unit, self.least, self.since, self.base = kind, unit, least, since, base
        self.starts: list[list[int]] = [[] for _ in range(unit)]

    def cheapest(self, k: int, best: list[float]) -> tuple[float, int] | None:
        """Cost and start of the cheapest span that ends at k, what lies before it included.

        As k grows, the span of a later start grows by a larger factor. So a start
        that an earlier one has beaten stays beaten, and so does one whose own cost
        is not below that of a later one: both are dropped for good, and few are
        left at a time.
        """
        new = k - self.least
        if new < self.since[k]:
            return None
        starts = self.starts[k % self.unit]
        if starts and starts[0] < self.since[k]:  # of an earlier run
            starts = []
        while starts and best[starts[-1]] >= best[new]:
            starts.pop()
        kept, least = [], math.inf
        for i in (*starts, new):
            cost = best[i] + math.log10((k - i) // self.unit)
            if cost < least:
                kept.append(i)
                least = cost
        self.starts[k % self.unit] = kept
        return least + self.base(k), kept[-1]


def all_runs(value: str) -> list[Runs]:
    """Repeats of a character or a block, sequences, and keyboard walks of the value."""
    low, n = lowered(value), len(value)

    def since(goes_on, shortest) -> list[int]:
        out = [0]
        for k in range(1, n + 1):
            out.append(out[-1] if goes_on(k) else max(0, k - shortest(k)))
        return out

    def step(k: int) -> int:
        return ord(low[k - 1]) - ord(low[k - 2]) if k > 1 else 0

    sequences = since(lambda k: k > 2 and abs(step(k)) == 1 and step(k) == step(k - 1), lambda k: 2 if abs(step(k)) == 1 else 1)
    walks = since(lambda k: k > 1 and (low[k - 2], low[k - 1]) in NEIGHBOURS, lambda k: 1)
    out = [
        Runs("sequence", 1, 3, sequences, lambda k: math.log10(26)),
        Runs("walk", 1, 3, walks, lambda k: math.log10(47 * 4)),
    ]
    for size in range(1, LONGEST_BLOCK + 1):
        text = low if size == 1 else value
        again = since(lambda k: k > size and text[k - 1] == text[k - 1 - size], lambda k: size)
        block = lambda k, text=text, size=size: size * math.log10(_alphabet(text[k - size : k]))
        out.append(Runs("repeat", size, max(3, 2 * size), again, block))
    return out


def guess_cost(value: str, words: dict[str, int] | None = None) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the guesses of the cheapest segmentation, and its spans.

    best[k] is the least cost of the first k characters: best[j] + the cost of a
    recognised span from j to k, or best[k-1] + one more brute-force character.
    An empty value costs nothing.
    """
    words = RANKS if words is None else words
    n = len(value)
    char = math.log10(_alphabet(value)) if n else 0.0
    ending: list[list[tuple[int, float, str]]] = [[] for _ in range(n + 1)]
    for i, j, cost, kind in listed(value, words):
        ending[j].append((i, cost, kind))
    runs = all_runs(value)
    best, back = [0.0], [(0, "")]
    for k in range(1, n + 1):
        cost, start, kind = best[k - 1] + char, k - 1, "brute"
        for i, c, name in ending[k]:
            if best[i] + c < cost:
                cost, start, kind = best[i] + c, i, name
        for run in runs:
            if (found := run.cheapest(k, best)) and found[0] < cost:
                (cost, start), kind = found, run.kind
        best.append(cost)
        back.append((start, kind))
    out: list[tuple[int, int, str]] = []
    k = n
    while k:
        start, kind = back[k]
        if kind == "brute" and out and out[-1][2] == "brute" and out[-1][0] == k:
            out[-1] = (start, out[-1][1], kind)
        else:
            out.append((start, k, kind))
        k = start
    return best[n], out[::-1]


def find(text: str, least: float = LEAST_GUESSES, words: dict[str, int] | None = None) -> tuple[list, list]:
    """Base spans (start, kind number, end) and the spans that the guess cost adds, each sorted.

    An added span is a value in a credential context, of least guess cost
    ``least``, that no base span covers already.
    """
    base = []
    if _ASSIGN_HINT.search(text):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    begins, reach = [s for s, _, _ in base], [*accumulate((e for _, _, e in base), max)]
    added = []
    if _ASSIGN_HINT.search(text):
        for m in CONTEXT.finditer(text):
            start, end = m.span(1)
            end = start + len(m[1].rstrip(".)]}!?:"))
            before = bisect_right(begins, start)
            if end - start < 6 or before and end <= reach[before - 1]:
                continue
            if guess_cost(text[start:end], words)[0] >= least:
                added.append((start, 3, end))
    return base, added


def joined(found: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans", "redacted")]
)


def scan_secrets(
    docs: DataFrame,
    least_guesses: float = LEAST_GUESSES,
    words: dict[str, int] | None = None,
    redact: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans, redacted.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then
    kind. ``redacted`` is the text with each secret replaced by ``[kind]``
    (overlapping spans together), or null unless ``redact``; a null text gives no
    spans and stays null. Repeated rows and null ids each keep their row. No
    shuffle, one text at a time.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in _SCHEMA])
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            null = batch.column(1).is_null().to_pylist()
            for (doc_id, raw), missing in zip(texts(batch), null):
                text = raw.decode("utf-8")
                base, added = find(text, least_guesses, words)
                n = [0] * len(KINDS)
                for _, k, _ in base + added:
                    n[k] += 1
                clean = hidden(text, base + added) if redact and not missing else None
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((doc_id, *n, digest, joined(base + added), clean))
                size += 200 + (len(clean) if clean else 0)
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return narrow(docs, id_col, text_col).mapInArrow(scan, _SCHEMA)


def hidden(text: str, found: list) -> str:
    """The text with its secrets replaced; overlapping spans become one."""
    out, at = [], 0
    merged: list[list[int]] = []
    for s, k, e in sorted(found):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([s, k, e])
    for s, k, e in merged:
        out += [text[at:s], f"[{KINDS[k]}]"]
        at = e
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """docs with the same columns and rows, secrets in the text replaced; ``length_col`` follows the text.

    Null and empty texts and those without secrets stay as they are, with their
    length; repeated rows are masked alike. An empty table gives no rows.
    """

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, words = options.get("least_guesses", LEAST_GUESSES), options.get("words")
        for batch in batches:
            names = batch.schema.names
            i = names.index(text_col)
            out, sizes = [], []
            old = batch.column(names.index(length_col)).to_pylist() if length_col in names else [None] * batch.num_rows
            for text, size in zip(batch.column(i), old):
                text = text.as_py()
                base, added = find(text, least, words) if text else ([], [])
                if base or added:
                    text = hidden(text, base + added)
                    size = len(text)
                out.append(text)
                sizes.append(size)
            batch = batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))
            if length_col in names:
                j = names.index(length_col)
                batch = batch.set_column(j, batch.schema.field(j), pa.array(sizes, batch.schema.field(j).type))
            yield batch

    return docs.mapInArrow(mask, docs.schema)
