"""Alignment of the tokens of two tokenizers, and how well each document's links agree with the corpus.

Both tokenizers cut the same bytes. Where a token of each ends, the bytes fall into
groups; tokens whose byte ranges overlap are linked. Exact duplicates are taken out
first: one shuffle by the full text, each distinct text is tokenised and aligned
once, what it adds to the corpus is weighted by its copies, and its measures are
joined back to the documents by the SHA-256 of the text.

A document's agreement needs the corpus counts of all its id pairs. Counts of the
commonest pairs (``MOST_CACHED``, 16 bytes each) go to the tasks; all other pairs
meet their counts in a join, so results are whole for any number of pairs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.shared import OUT_BYTES, commonest, materialize, release

#: Pairs whose counts are sent to the tasks.
MOST_CACHED = 1 << 20
#: Pair counts that a task holds before it sums them up.
HELD_PAIRS = 2_000_000
#: The published pattern that splits a text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Token ids of both tokenizers for one text, and their alignment.

    Where the byte-level file is a plain one (ids in the order of the merges, the published
    pattern, no normaliser), a merge of ranks gives the same ids as its library at a
    quarter of the time; other files go through the library.
    """

    def __init__(self, byte_level_path: str, pieces_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(byte_level_path)
        self.library.encode_special_tokens = True
        self.library.no_padding()
        self.library.no_truncation()
        config = json.loads(self.library.to_str())
        letters, added = byte_letters(), {t["id"]: t["content"] for t in config["added_tokens"]}
        entries = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [b""] * (max(entries) + 1)
        for i, entry in entries.items():
            self.bytes_a[i] = added[i].encode() if i in added else bytes(letters[c] for c in entry)
        self.ranks = self._ranks(config, added)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        self.bits = max(1, len(self.bytes_b) - 1).bit_length()
        # decimal ids with what follows them in the list of groups, by kind: in a group, at its end
        ids_a, ids_b = [b"%d" % i for i in range(len(self.bytes_a))], [b"%d" % i for i in range(len(self.bytes_b))]
        self.shown = [x + b"," for x in ids_a] + [x + b"|" for x in ids_a] + [x + b"," for x in ids_b] + [x + b";" for x in ids_b]

    def _ranks(self, config: dict, added: dict[int, str]):
        import tiktoken

        model, split = config["model"], {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        ranks = {x: i for i, x in enumerate(self.bytes_a) if i not in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        in_order = all(model["vocab"].get("".join(m)) == 256 + i for i, m in enumerate(pairs)) and len(ranks) == 256 + len(pairs)
        plain = config["normalizer"] is None and split.items() <= (config["pre_tokenizer"] or {}).items()
        plain = plain and not (model.get("dropout") or model.get("ignore_merges") or model.get("end_of_word_suffix"))
        if plain and in_order:
            return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return None

    def ids_a(self, whole: str) -> list[int]:
        return self.ranks.encode_ordinary(whole) if self.ranks else self.library.encode(whole, add_special_tokens=False).ids

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None where the tokens of either do not give back space + text."""
        whole = b" " + text.encode()
        a = self.ids_a(" " + text)
        if b"".join([self.bytes_a[i] for i in a]) != whole:
            return None
        b = self.b.encode(text)
        if b"".join([self.bytes_b[i] for i in b]) != whole:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, bytes]:
        """(number of groups, the pair of each link as a << bits | b, the groups as text).

        Each stretch between neighbouring token ends lies in one token of each side,
        and each overlap of two tokens is one such stretch: so stretches are the links.
        """
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # merges the two
        again = np.append(ends[1:] == ends[:-1], False)
        common, ends = ends[again], ends[~again]
        links = a[np.searchsorted(end_a, ends)] << self.bits | b[np.searchsorted(end_b, ends)]
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        last_a, last_b = common[group_a] == end_a, common[group_b] == end_b
        order = np.empty(len(a) + len(b), dtype=np.int64)
        # tokens of A stand after the tokens of B of earlier groups, those of B after A's of their own group too
        n_a, n_b = np.searchsorted(group_a, np.arange(len(common)), "right"), np.searchsorted(group_b, np.arange(len(common)), "right")
        before_a = np.concatenate([[0], n_b])[group_a]
        order[np.arange(len(a)) + before_a] = a + len(self.bytes_a) * last_a
        order[np.arange(len(b)) + n_a[group_b]] = 2 * len(self.bytes_a) + b + len(self.bytes_b) * last_b
        shown = self.shown
        return len(common), links, b"".join([shown[i] for i in order.tolist()])[:-1]


@lru_cache(maxsize=1)
def aligner(byte_level_path: str, pieces_path: str) -> Aligner:
    """One for each Python worker; it loads the vocabularies."""
    return Aligner(byte_level_path, pieces_path)


def align_texts(texts: DataFrame, byte_level_path: str, pieces_path: str) -> DataFrame:
    """For each row of (text, copies): key, copies, the measures, the distinct pairs and how many links each has (int64 and int32 arrays)."""
    schema = f"key binary, copies long, {MEASURES}, pairs binary, links binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_level_path, pieces_path)
        rows: list[tuple] = []
        size = 0

        def out():
            types = [pa.binary(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for text, copies in zip(batch.column(0), batch.column(1).to_pylist()):
                text = text.as_py()
                key, ids = hashlib.sha256(text.encode()).digest(), tool.encode(text)
                if ids is None:
                    rows.append((key, copies, 0, 0, 0, 0, "", b"", b""))
                else:
                    groups, links, shown = tool.align(*ids)
                    pairs, times = np.unique(links, return_counts=True)
                    digest = hashlib.sha256(shown).hexdigest()
                    rows.append((key, copies, len(ids[0]), len(ids[1]), groups, len(links), digest, pairs.tobytes(), times.astype(np.int32).tobytes()))
                    size += 12 * len(pairs)
                size += 200
                if size >= OUT_BYTES:
                    yield out()
                    rows, size = [], 0
        if rows:
            yield out()

    return texts.select("text", "copies").mapInArrow(work, schema)


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pairs, copies) to (pair, docs): summed in the task while it holds few enough."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    size, least = 0, HELD_PAIRS

    def reduced() -> tuple[np.ndarray, np.ndarray]:
        pair, docs = np.concatenate([p for p, _ in parts]), np.concatenate([d for _, d in parts])
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        return pair[at], np.add.reduceat(docs[order], at)

    def out(pair: np.ndarray, docs: np.ndarray):
        for i in range(0, len(pair), 250_000):
            yield pa.RecordBatch.from_arrays([pa.array(pair[i : i + 250_000]), pa.array(docs[i : i + 250_000])], ["pair", "docs"])

    for batch in batches:
        for pairs, copies in zip(batch.column(0), batch.column(1).to_pylist()):
            pairs = np.frombuffer(pairs.as_buffer(), dtype=np.int64)
            if len(pairs):
                parts.append((pairs, np.full(len(pairs), copies, dtype=np.int64)))
                size += len(pairs)
            if size >= least:
                parts = [reduced()]
                size = len(parts[0][0])
                if size >= HELD_PAIRS // 2:
                    yield from out(*parts[0])
                    parts, size = [], 0
                least = size + HELD_PAIRS
    if parts:
        yield from out(*reduced())


def pair_counts(aligned: DataFrame, bits: int) -> DataFrame:
    """(pair, docs, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = aligned.select("pairs", "copies").mapInArrow(_sum_pairs, "pair long, docs long")
    counts = counts.groupBy("pair").agg(F.sum("docs").alias("docs"))
    own = Window.partitionBy(F.shiftright("pair", bits))  # at most a row for each entry of B's vocabulary
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(own))


def align_documents(
    docs: DataFrame,
    byte_level_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_cached: int = MOST_CACHED,
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Tokens of A are those of space + text, tokens of B those of the text (that tokenizer adds
    the space itself). n_best counts the links whose pair has the corpus-wide highest count of its A
    id, count_sum adds up the counts over the links; a pair's count is the number of documents that hold it.

    Null and empty texts, and texts that the tokens of either side do not give back byte
    by byte, have zeros and an empty groups_sha256, and add to no count. Repeated rows and null ids
    each keep their row and each count as a document.
    """
    spark = docs.sparkSession
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    texts = rows.where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned = materialize(align_texts(texts, byte_level_path, pieces_path), "aligned")
    bits = aligner(byte_level_path, pieces_path).bits
    counts = materialize(pair_counts(aligned, bits), "pair-counts")
    hot, cold = commonest(counts, "docs", most_cached)
    table = hot.toArrow()  # most_cached rows at most
    order = np.argsort(pair := table["pair"].to_numpy())
    cache = spark.sparkContext.broadcast((pair[order], table["docs"].to_numpy()[order], np.asarray(table["best"])[order]))
    plain = [f.split()[0] for f in MEASURES.split(", ")]
    schema = f"key binary, {MEASURES}, n_best long, count_sum long, rest array<bigint>, rest_links array<int>"
    names = [f.split()[0] for f in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs_of, best_of = cache.value
        for batch in batches:
            found = [[], [], [], []]
            for pairs, links in zip(batch.column("pairs"), batch.column("links")):
                pairs, links = np.frombuffer(pairs.as_buffer(), dtype=np.int64), np.frombuffer(links.as_buffer(), dtype=np.int32)
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                met = known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
                at, times = at[met], links[met].astype(np.int64)
                found[0].append(int(times[best_of[at]].sum()))
                found[1].append(int((times * docs_of[at]).sum()))
                found[2].append(pairs[~met])
                found[3].append(links[~met])
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            columns = [batch.column(n) for n in ("key", *plain)] + [pa.array(f, t) for f, t in zip(found, types)]
            yield pa.RecordBatch.from_arrays(columns, names)

    scored = aligned.select("key", *plain, "pairs", "links").mapInArrow(work, schema)
    if not cold.isEmpty():
        scored = materialize(scored, "aligned-scores")
        rest = scored.select("key", F.explode(F.arrays_zip("rest", "rest_links")).alias("x"))
        met = rest.select("key", F.col("x.rest").alias("pair"), F.col("x.rest_links").cast("long").alias("links")).join(cold, "pair")
        more = met.groupBy("key").agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("docs")).alias("more_sum")
        )
        scored = scored.join(more, "key", "left").withColumns(
            {"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}
        )
    scored = scored.select("key", *plain, "n_best", "count_sum")
    key = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("key")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = rows.select("doc_id", key).join(scored, "key", "left").na.fill(0, numbers).na.fill("", ["groups_sha256"])
    out = materialize(out.select("doc_id", *numbers, "groups_sha256"), "alignment")
    release(aligned, counts, scored)
    cache.destroy()
    return out
