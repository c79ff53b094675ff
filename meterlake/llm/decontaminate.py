"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Each test item gives its word n-grams, and all of them are seeds: an edit may leave
only common ones. Documents that hold a seed give the segment of words around it,
and each segment is aligned with the items of its seeds: a local alignment by
words, so that edited copies with words changed, added or left out still score.
Items and documents meet by a join on grams; before it, a bitmap of bounded size
drops the grams that no item has, and pairs that have too few words in common for
the least score are not aligned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import Bitmap, materialize, narrow, texts
from meterlake.llm.words import distinct, shingles, word_hashes

#: Words of a seed.
GRAM = 4
#: Scores of the alignment, and the least score as a share of the item's own.
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SIMILARITY = 0.5

_SIGNS = b".,;:!?\"'()[]{}"
_APART = bytes.maketrans(_SIGNS, b" " * len(_SIGNS))
#: The bitmaps have so many bits for each gram of the items: nearly no other gram passes.
BITS_EACH = 2**13


def words_of(text: bytes) -> np.ndarray:
    """Hashes of the words, A-Z lower-cased; the usual signs separate words too."""
    return word_hashes(text.translate(_APART))


def align(item: np.ndarray, segment: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the segment's words [start, end) that it covers.

    A row of the table for each word of the item; gaps along the row are a running
    maximum. Starts are carried with the scores: score * 2**32 - start is maximised,
    so of equal scores the earliest start is kept.
    """
    n = len(segment)
    if not n or not len(item):
        return 0, 0, 0
    unit = np.int64(1) << np.int64(32)
    places = np.arange(n, dtype=np.int64)
    slope = places * np.int64(-GAP) * unit
    anew = -places - 1  # nothing aligned yet, and the next word is a start
    row = np.append(0, anew)  # row[j]: best ending before segment word j
    best = (0, 0, 0)
    for word in item:
        step = np.where(segment == word, MATCH, MISMATCH).astype(np.int64) * unit
        diagonal = row[:-1] + step
        above = row[1:] + GAP * unit
        now = np.maximum(np.maximum(diagonal, above), anew)
        now = np.maximum.accumulate(now + slope) - slope
        j = int(now.argmax())
        score = int((now[j] + unit - 1) >> np.int64(32))
        if score > best[0]:
            best = score, int(score * int(unit) - int(now[j])), j + 1
        row = np.append(0, now)
    return best


def common_words(item: np.ndarray, segment: np.ndarray) -> int:
    """Words of the item that the segment has too, as often as both have them: an alignment matches no more."""
    kinds, n = np.unique(item, return_counts=True)
    at = np.searchsorted(kinds, segment)
    at[at == len(kinds)] = 0
    found = np.bincount(at[kinds[at] == segment], minlength=len(kinds))
    return int(np.minimum(n, found).sum())


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    least: float = LEAST_SIMILARITY,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, similarity, start_word, end_word of each document and item that align well enough.

    ``similarity`` is the alignment's score as a share of the item's score with
    itself; the words, counted as by ``words_of``, are the best segment's. Rows that repeat an id count as one
    document. Null or empty texts and items match nothing; an item of fewer words
    than a seed has its whole text as its seed. Items that share an id are aligned
    each, and the best counts. Empty tables give no rows.
    """
    spark = docs.sparkSession
    tests = narrow(items, item_col, item_text_col).select(F.col("doc_id").alias("item_id"), "text")

    def item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in texts(batch):
                if len(words := words_of(text)):
                    cols = [pa.array([item_id], pa.int64()), pa.array([words.tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, ["item_id", "item"])

    def item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, item in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = distinct(shingles(np.frombuffer(item, np.uint64), gram)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), key)), pa.array(found)], ["key", "gram"])

    # an item is known by its id and words; its words are kept once, its grams by its key
    bodies = tests.mapInArrow(item_words, "item_id long, item binary").withColumn("key", F.xxhash64("item_id", "item"))
    bodies = materialize(bodies.dropDuplicates(["key"]), "items")
    seeds = materialize(bodies.select("key", "item").mapInArrow(item_grams, "key long, gram long"), "seeds")
    chosen = seeds.select("gram").distinct()
    seeded = spark.sparkContext.broadcast(Bitmap.of(chosen, "gram", chosen.count(), BITS_EACH))
    longest = (bodies.agg(F.max(F.octet_length("item"))).first()[0] or 0) // 8
    rows = narrow(docs, id_col, text_col)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each document, the runs of words around its seeds; each reaches an item's length to both sides."""
        bits = seeded.value
        for batch in batches:
            for doc_id, text in texts(batch):
                words = words_of(text)
                found = shingles(words, gram)
                at = np.flatnonzero(bits.has(found)) if len(found) else ()
                if not len(at):
                    continue
                out: dict[str, list] = {"doc_id": [], "start": [], "words": [], "grams": []}
                for run in np.split(at, np.flatnonzero(np.diff(at) > 2 * longest) + 1):
                    start, end = max(0, int(run[0]) - longest), int(run[-1]) + gram + longest
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["words"].append(words[start:end].tobytes())
                    out["grams"].append(np.unique(found[run]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["doc_id"], pa.int64()),
                        pa.array(out["start"], pa.int64()),
                        pa.array(out["words"], pa.binary()),
                        pa.array([g.tolist() for g in out["grams"]], pa.list_(pa.int64())),
                    ],
                    list(out),
                )

    parts = materialize(
        rows.mapInArrow(segments, "doc_id long, start long, words binary, grams array<bigint>").withColumn(
            "part", F.xxhash64("doc_id", "start", "words")
        ),
        "segments",
    )
    met = parts.select("part", F.explode("grams").alias("gram")).join(seeds, "gram").select("part", "key").distinct()
    pairs = met.join(parts.drop("grams").dropDuplicates(["part"]), "part").join(bodies, "key")
    pairs = pairs.select("doc_id", "start", "words", "item_id", "item")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, start, words, item_id, item in zip(*(c.to_pylist() for c in batch.columns)):
                own, segment = np.frombuffer(item, np.uint64), np.frombuffer(words, np.uint64)
                if common_words(own, segment) < least * len(own):
                    continue
                points, first, last = align(own, segment)
                if points >= least * MATCH * len(own):
                    out.append((doc_id, item_id, points / (MATCH * len(own)), start + first, start + last))
            names = ["doc_id", "item_id", "similarity", "start_word", "end_word"]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            cols = zip(*out) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    scored = pairs.mapInArrow(score, "doc_id long, item_id long, similarity double, start_word long, end_word long")
    best = F.max_by(
        F.struct("similarity", "start_word", "end_word"), F.struct("similarity", -F.col("start_word"))
    )
    return scored.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
