"""Token counts by prefix dynamic programming.

For a byte-pair vocabulary with word ends, the last token of every prefix of a
word decides its whole encoding: a sequence of tokens is the encoding exactly
when each neighbouring pair is one (encoding the two tokens' characters gives
the same two tokens back). So for each prefix the table keeps the last token
and the count, built from the entry before that token. Two tables are filled:
one for prefixes inside a word, one for prefixes that end the word. The count
at every prefix of a text is then known, and questions of truncation and budget
are answered from the stored counts without encoding again.

Counts are of the library's encoding of each prefix as a text of its own. They
are kept as one signed byte a code point: the change from the prefix before.
"""

from __future__ import annotations

import json
import re
import unicodedata
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.shared import narrow, texts
from meterlake.llm.words import Recent

#: Pairs of tokens that a task remembers.
REMEMBERED = 400_000
#: Text whose new words are looked at together.
GROUP_BYTES = 8_000_000

# Fixed values of the vocabulary's splitting rule: after an apostrophe that
# starts a piece, these letters belong to it.
CONTRACTIONS_1 = "stmd"
CONTRACTIONS_2 = {"r": "e", "v": "e", "l": "l"}

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
_LETTERS, _NUMBERS, _SPACES = regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"\s")
#: A run of letters, then signs without an apostrophe or the start of a special string.
_PLAIN = regex.compile(r"([A-Za-z]*|\p{L}*)([!-&(-/:;=>?@\[-`{-~]*)")
_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    symbols = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [symbols[b] for b in range(256)]


class PrefixTable:
    """Counts at every prefix for one vocabulary file; lives in a task.

    Tokens are numbered by the order of their merges, single symbols first.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        end = spec["model"]["end_of_word_suffix"]
        self.specials = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")")
        self.symbol = _byte_symbols()
        self.symbols = "".join(self.symbol)
        number = {c + e: i for i, (c, e) in enumerate((c, e) for e in ("", end) for c in self.symbol)}
        self.base = len(number)
        self.halves = [(i, i) for i in range(self.base)]
        self.join: dict[tuple[int, int], int] = {}
        for left, right in merges:
            pair = number[left], number[right]
            self.join[pair] = number[left + right] = len(self.halves)
            self.halves.append(pair)
        self.memo: dict[tuple[int, int], bool] = {}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for token, i in number.items():  # a token that its own characters never give is not used
            if i < self.base or self.apart(*self.halves[i], i):
                (self.final if token.endswith(end) else self.inner)[token.removesuffix(end)] = i
        # each ending of a token: the token's number if it is one itself, else -1
        self.inner = {t[i:]: -1 for t in self.inner for i in range(len(t))} | self.inner
        self.final = {t[i:]: -1 for t in self.final for i in range(len(t))} | self.final
        self.chunks = Recent(self._chunk)
        self.word = Recent(self._word).__getitem__
        self.before, self.counts, self.entries = "", [], ([0], [0])

    def apart(self, left: int, right: int, limit: int | None = None) -> bool:
        """Do the two tokens stay apart when their characters are encoded together?

        The two are taken back merge by merge, latest first, along the seam; they
        stay apart unless some merge across the seam comes before the merge that
        hides it. ``limit`` asks the same for merges before that one alone.
        """
        key = (left, right) if limit is None else None
        if key is not None and (known := self.memo.get(key)) is not None:
            return known
        join, halves = self.join, self.halves
        bound = limit if limit is not None else len(halves)
        while True:
            if join.get((left, right), bound) < bound:
                out = False
                break
            if left < self.base and right < self.base:
                out = True
                break
            if left > right:
                bound, left = left, halves[left][1]
            else:
                bound, right = right + 1, halves[right][0]
        if key is not None:
            if len(self.memo) >= REMEMBERED:
                self.memo.clear()
            self.memo[key] = out
        return out

    def grow(self, piece: str, last: list[int], count: list[int]) -> None:
        """Fill the inside-the-word entries of the prefixes of ``piece`` that have none yet."""
        inner, memo, apart = self.inner.get, self.memo.get, self.apart
        start = len(last) - 1  # of the last token so far; a prefix has one encoding, so the order of the trials is free
        for i in range(len(last), len(piece) + 1):
            token = inner(piece[start:i], -2)
            if token < 0 or start and not (apart(*pair) if (known := memo(pair := (last[start], token))) is None else known):
                start = i - 1
                while (token := inner(piece[start:i], -2)) != -2:
                    if token >= 0:
                        if start == 0 or (apart(*pair) if (known := memo(pair := (last[start], token))) is None else known):
                            break
                    if start == 0:
                        raise ValueError(f"no token ends {piece[:i]!r}")
                    start -= 1
                else:
                    raise ValueError(f"no token ends {piece[:i]!r}")
            last.append(token)
            count.append(count[start] + 1)

    def closed(self, piece: str, n: int, last: list[int], count: list[int]) -> int:
        """Tokens of the first n symbols of ``piece`` as a whole word."""
        return self.all_closed(piece, (n,), last, count)[0] if n else 0

    def all_closed(self, piece: str, ends, last: list[int], count: list[int]) -> list[int]:
        """The same for some ends, none of them 0; the last token's start is first tried where the one before had it."""
        final, memo, apart = self.final.get, self.memo.get, self.apart
        out, j = [], len(piece)
        for n in ends:
            token = final(piece[j:n], -2)
            if token < 0 or j and not (apart(*pair) if (known := memo(pair := (last[j], token))) is None else known):
                j = n - 1
                while (token := final(piece[j:n], -2)) != -2:
                    if token >= 0:
                        if j == 0 or (apart(*pair) if (known := memo(pair := (last[j], token))) is None else known):
                            break
                    if j == 0:
                        raise ValueError(f"no token ends {piece[:n]!r}")
                    j -= 1
                else:
                    raise ValueError(f"no token ends {piece[:n]!r}")
            out.append(count[j] + 1)
        return out

    def _word(self, text: str) -> bytes:
        """Changes of the count at the prefixes of a piece that the splitting rule keeps whole.

        The entries of the prefix that it shares with the piece before are used
        again: pieces in alphabetical order have few new prefixes.
        """
        same, (last, count) = 0, self.entries
        while text[same : same + 1] == self.before[same : same + 1] != "":
            same += 1
        if text.isascii():
            piece, ends = text, range(1, len(text) + 1)  # ASCII letters and signs stand for themselves
        else:
            piece = charmap_decode(text.encode("utf-8"), "strict", self.symbols)[0]
            ends = list(accumulate([1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4 for c in text]))
        kept = ends[same - 1] if same else 0
        del last[kept + 1 :], count[kept + 1 :]
        self.before = ""
        self.grow(piece, last, count)
        out = self.counts[:same] + self.all_closed(piece, ends[same:], last, count)
        self.before, self.counts = text, out
        return _changes(out)

    def learn(self, texts: list[bytes]) -> dict[str, bytes]:
        """The chunks of several texts, new ones worked out in alphabetical order."""
        chunks = set()
        for text in texts:
            chunks.update(text.translate(_TO_SPACE).decode("utf-8").split(" "))
        known = {chunk: self.chunks[chunk] for chunk in filter(self.chunks.has, chunks)}
        chunks.difference_update(known)
        for chunk in sorted(chunks, key=str.lower):
            known[chunk] = self.chunks[chunk]
        return known

    def deltas(self, text: bytes, known: dict[str, bytes] | None = None) -> bytes:
        """One signed byte a code point of the text: the change of the count at that prefix; ``known`` is what learn gave."""
        if not text:
            return b""
        return b"\0".join(map((known or self.chunks).__getitem__, text.translate(_TO_SPACE).decode("utf-8").split(" ")))

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if chunk.isascii() and chunk.isalpha():
            return self.word(chunk.lower())
        plain = _PLAIN.fullmatch(chunk)
        if plain and (lower := chunk.lower()) and len(lower) == len(chunk) and (chunk.isascii() or _simple(chunk)):
            at = plain.end(1)
            return self.word(lower[:at]) + self.word(lower[at:]) if at < len(chunk) else self.word(lower)
        return _changes(_Scan(self).chunk(chunk))


def _changes(counts: list[int]) -> bytes:
    """The counts as signed bytes, each the change from the count before."""
    return bytes([(c - b) & 255 for b, c in zip([0, *counts], counts)])


def _simple(chunk: str) -> bool:
    """Letters that neither normalising nor lower-casing in context changes further."""
    return unicodedata.is_normalized("NFC", chunk) and "Σ" not in chunk


class _Scan:
    """Reads one chunk (a text without ASCII white space), a code point at a time."""

    def __init__(self, table: PrefixTable):
        self.t = table
        self.done = 0  # tokens of closed pieces
        self.open()

    def open(self, kind: int | None = None) -> None:
        self.kind, self.piece = kind, ""
        self.last, self.count = [0], [0]  # by prefix of the open piece, inside a word
        self.quote = ""  # of a piece that may still become a contraction

    def grow(self, ch: str) -> None:
        """Append one code point to the open piece, as byte symbols."""
        self.piece += "".join([self.t.symbol[b] for b in ch.encode("utf-8")])
        self.t.grow(self.piece, self.last, self.count)

    def closed(self) -> int:
        """Tokens of the open piece if the word ended here."""
        return self.t.closed(self.piece, len(self.piece), self.last, self.count)

    def close(self) -> None:
        self.done += self.closed()
        self.open()

    def total(self) -> int:
        return self.done + self.closed()

    def feed(self, ch: str) -> None:
        """One code point of the normalised text."""
        if ch.isascii():
            kind = LETTER if ch.isalpha() else NUMBER if ch.isdigit() else OTHER
        else:
            kind = LETTER if _LETTERS.match(ch) else NUMBER if _NUMBERS.match(ch) else SPACE if _SPACES.match(ch) else OTHER
        if ch.isspace() and _SPACES.match(ch):
            kind = SPACE
        quote = self.quote
        self.quote = ""
        if quote == "'" and ch in CONTRACTIONS_1:
            self.grow(ch)
            self.close()
            return
        if len(quote) == 2 and CONTRACTIONS_2[quote[1]] == ch:
            self.open()
            self.done -= self.before
            for c in quote + ch:
                self.grow(c)
            self.close()
            return
        if kind != self.kind or kind == NUMBER or not self.piece:
            apostrophe = quote == "'" and ch in CONTRACTIONS_2
            self.before = self.closed() if apostrophe else 0
            self.close()
            if apostrophe:
                self.quote = quote + ch
        if kind == SPACE:
            return
        if not self.piece:
            self.kind = kind
            if ch == "'":
                self.quote = "'"
        self.grow(ch)

    def state(self):
        return (self.done, self.kind, self.piece, self.quote, getattr(self, "before", 0), len(self.last))

    def restore(self, state, last, count) -> None:
        self.done, self.kind, self.piece, self.quote, self.before, n = state
        self.last, self.count = last[:n], count[:n]

    def chunk(self, chunk: str) -> list[int]:
        """The count at each prefix of the chunk."""
        out: list[int] = []
        parts = self.t.special_re.split(chunk) if "<|" in chunk else [chunk]
        for k, part in enumerate(parts):
            if k % 2:  # a special string: its proper prefixes are ordinary text
                saved = self.state(), list(self.last), list(self.count)
                out += self.plain(part[:-1])
                self.restore(*saved)
                self.close()
                self.done += 1
                out.append(self.total())
            else:
                out += self.plain(part)
        return out

    def plain(self, text: str) -> list[int]:
        out = []
        if text.isascii():
            for ch in text.lower():
                self.feed(ch)
                out.append(self.total())
            return out
        i, n = 0, len(text)
        while i < n:
            j = i + 1
            while j < n and not _starts(text[j]):
                j += 1
            if j - i == 1:
                for ch in unicodedata.normalize("NFC", text[i]):
                    self._lower(ch)
                out.append(self.total())
            else:  # marks that may compose: each prefix of the run is normalised by itself
                saved = self.state(), list(self.last), list(self.count)
                for k in range(i + 1, j + 1):
                    self.restore(*saved)
                    for ch in unicodedata.normalize("NFC", text[i:k]):
                        self._lower(ch)
                    out.append(self.total())
            i = j
        return out

    def _lower(self, ch: str) -> None:
        for c in ch.lower():
            self.feed(c)


def _starts(ch: str) -> bool:
    """Does normalisation begin anew at this code point?"""
    if ch.isascii():
        return True
    return unicodedata.combining(ch) == 0 and unicodedata.category(ch)[0] != "M" and not "ᅠ" <= ch <= "ᇿ"


_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("chars_in_budget", T.LongType()),
        T.StructField("prefix_deltas", T.BinaryType()),
    ]
)
_TABLES: dict[str, PrefixTable] = {}


def prefix_counts(
    docs: DataFrame,
    vocabulary: str,
    budget: int = 2048,
    keep_prefixes: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_chars, n_tokens, chars_in_budget, prefix_deltas.

    ``prefix_deltas`` holds the count at every prefix (see ``count_at``);
    ``chars_in_budget`` is the longest prefix of at most ``budget`` tokens.
    A null or empty text has no tokens. One row out for each row in: repeated
    rows and null ids stay. Other columns are not read. ``vocabulary`` is a
    path that each executor can open; no shuffle, one text at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _TABLES.get(vocabulary) or _TABLES.setdefault(vocabulary, PrefixTable(vocabulary))
        schema = pa.schema(
            [(f.name, pa.binary() if f.name == "prefix_deltas" else pa.int64()) for f in _SCHEMA]
        )
        for group in groups(batches):
            known = table.learn([text for _, text in group])
            rows = []
            for doc_id, text in group:
                deltas = table.deltas(text, known)
                at = np.cumsum(np.frombuffer(deltas, dtype=np.int8), dtype=np.int64)
                n = int(at[-1]) if len(at) else 0
                within = np.flatnonzero(at <= budget) if n > budget else ()
                fits = len(at) if n <= budget else int(within[-1]) + 1 if len(within) else 0
                rows.append((doc_id, len(text), len(at), n, fits, deltas if keep_prefixes else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, bytes]]]:
        """Rows of about GROUP_BYTES of text together."""
        group: list[tuple[int | None, bytes]] = []
        size = 0
        for batch in batches:
            for row in texts(batch):
                group.append(row)
                size += len(row[1]) + 100
                if size > GROUP_BYTES:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    return narrow(docs, id_col, text_col).mapInArrow(count, _SCHEMA)


def count_at(deltas: str, prefix: int | str):
    """Column: tokens of the first ``prefix`` code points, from the stored deltas.

    A prefix beyond the end counts the whole text; 0 or less counts nothing.
    """

    @F.pandas_udf(T.LongType())
    def at(stored: pd.Series, length: pd.Series) -> pd.Series:
        sums = [
            None if s is None or pd.isna(k) else int(np.frombuffer(s, dtype=np.int8)[: max(0, int(k))].sum(dtype=np.int64))
            for s, k in zip(stored, length)
        ]
        return pd.Series(sums, dtype="Int64")

    return at(F.col(deltas), F.lit(prefix) if isinstance(prefix, int) else F.col(prefix))


def truncate(deltas: str, text: str, budget: int):
    """Column: the longest prefix of ``text`` whose stored count is at most ``budget``."""

    @F.pandas_udf(T.StringType())
    def cut(stored: pd.Series, whole: pd.Series) -> pd.Series:
        out = []
        for s, w in zip(stored, whole):
            fits = np.flatnonzero(np.cumsum(np.frombuffer(s or b"", dtype=np.int8), dtype=np.int64) <= budget)
            out.append(None if w is None else w[: int(fits[-1]) + 1] if len(fits) else "")
        return pd.Series(out, dtype=object)

    return cut(F.col(deltas), F.col(text))
