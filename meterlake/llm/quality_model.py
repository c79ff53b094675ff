"""Quality classifier: logistic regression over hashed word n-grams, learned by FTRL.

Training takes a bounded sample of labelled rows, split into shards; each shard
makes follow-the-regularised-leader updates over its documents from the common
weights, and the shards' weights are averaged, a few rounds over. A document's
features are its distinct hashed words and word pairs, scaled to unit length, so
that long texts weigh no more than short ones. The model is one vector of fixed
size; scoring is a sparse dot product with it, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import crc_part, materialize, narrow, release, texts
from meterlake.llm.words import Recent, mix

#: Parameters of the model. At most MAX_TRAIN labelled rows are learned from: the
#: first by a hash of their id.
BITS = 18
MAX_TRAIN = 16_000
MOST_SHARDS, SHARD_ROWS = 8, 500
ROUNDS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-3

_LETTERS = bytes(
    ord("a") if 97 <= b < 123 or b > 127 else ord("A") if 65 <= b < 91 else ord("0") if 48 <= b < 58 else b for b in range(256)
)


def shapes(text: bytes) -> list[bytes]:
    """The words with their letters, capitals and digits made equal and runs of one sign shortened: "Then," is "Aa,".

    Blanks are signs of their own, so a whole text is rewritten at once and has the same words after.
    """
    signs = np.frombuffer(text.translate(_LETTERS), dtype=np.uint8)
    return signs[np.append(signs[1:] != signs[:-1], True)[: len(signs)]].tobytes().split()


#: Shapes whose hashes a worker remembers. Words are hashed as they come: so many are rare that looking them up takes longer.
REMEMBERED = 40_000
_WORD = Recent(xxhash.xxh3_64_intdigest, REMEMBERED)
_SHAPE = Recent(xxhash.xxh3_64_intdigest, REMEMBERED)


def features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the text's hashed n-grams; none without words.

    Distinct words and word pairs weigh the same and have unit length together;
    word shapes, their pairs and words that follow themselves weigh by their
    share of the text.
    """
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0)
    own = np.fromiter(map(_WORD.compute, words), dtype=np.uint64, count=n)
    forms = np.fromiter(map(_SHAPE.__getitem__, shapes(text)), dtype=np.uint64, count=n)
    shift = np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        pairs = mix(own[:-1] * np.uint64(3) + own[1:])
        grams = np.unique(mix(np.concatenate([own, pairs + np.uint64(1)])) >> shift)
        steps = mix(forms[:-1] * np.uint64(5) + forms[1:])
        same = np.full(int((own[1:] == own[:-1]).sum()), np.uint64(2**64 - 1))
        looks, counts = np.unique(mix(np.concatenate([forms, steps, same]) + np.uint64(2)) >> shift, return_counts=True)
    values = np.concatenate([np.full(len(grams), len(grams) ** -0.5), counts / n])
    return np.concatenate([grams, looks]).astype(np.int64), values


def ftrl(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, z: np.ndarray, n: np.ndarray) -> None:
    """One pass of FTRL-proximal updates over the documents, in place; the last entry is the bias."""
    bias = len(z) - 1
    for (buckets, values), label in zip(docs, labels):
        at, x = np.append(buckets, bias), np.append(values, 1.0)
        w = weights(z[at], n[at])
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
        z[at] += g - sigma * w
        n[at] += g * g


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader under L1 and L2: zero where |z| is within L1."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> np.ndarray:
    """Weights (2**BITS buckets and a bias) learned from at most ``max_train`` labelled rows.

    Rows without an id, a label or a text are not learned from; an id that is
    labelled twice counts once, with its lowest label, and so does one that has
    several texts, with the least of them. Without any row the
    weights are zero and every score is 0.5.
    """
    picked = (
        labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    rows = narrow(docs, id_col, text_col).where("text IS NOT NULL")
    # bounded by max_train rows of two numbers
    sample = rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    sample = materialize(sample, "train-sample")
    count = max(1, min(MOST_SHARDS, sample.count() // SHARD_ROWS))
    sharded = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(count)))
    size = 2**BITS + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(ROUNDS):
        start = docs.sparkSession.sparkContext.broadcast((z, n))  # of fixed size

        def learn(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["doc_id"], key=lambda s: mix(s.to_numpy().astype(np.uint64)), kind="stable")
            own_z, own_n = (a.copy() for a in start.value)
            found = [features(t.encode()) for t in pdf["text"]]
            ftrl(found, pdf["label"].to_numpy(dtype=float), own_z, own_n)
            moved = np.flatnonzero((own_z != start.value[0]) | (own_n != start.value[1]))
            return pd.DataFrame({"bucket": moved, "z": own_z[moved], "n": own_n[moved]})

        # a shard has max_train / MOST_SHARDS rows or so; one that did not move a bucket holds the common value
        shards = sharded.groupBy("shard").applyInPandas(learn, "bucket long, z double, n double")
        table = shards.groupBy("bucket").agg(F.count("*").alias("k"), F.sum("z").alias("z"), F.sum("n").alias("n"))
        got = table.toArrow()  # 2**BITS + 1 rows at most
        if not got.num_rows:
            break
        at, k = got["bucket"].to_numpy(), got["k"].to_numpy()
        z[at] = (got["z"].to_numpy() + (count - k) * z[at]) / count
        n[at] = (got["n"].to_numpy() + (count - k) * n[at]) / count
    release(sample)
    return weights(z, n)


def score(
    docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score (0 to 1, from the text alone) of each row; a null or empty text scores the bias."""
    shipped = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shipped.value
        for batch in batches:
            ids, scores = [], []
            for doc_id, text in texts(batch):
                at, x = features(text)
                s = min(35.0, max(-35.0, float(w[-1]) + float(w[at] @ x)))
                ids.append(doc_id)
                scores.append(1.0 / (1.0 + np.exp(-s)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: np.ndarray, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores ``least`` or more; their columns are left alone."""
    shipped = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shipped.value
        for batch in batches:
            on = []
            for text in batch.column(batch.schema.names.index(text_col)).cast(pa.binary()):
                at, x = features(text.as_buffer().to_pybytes() if text.is_valid else b"")
                s = min(35.0, max(-35.0, float(w[-1]) + float(w[at] @ x)))
                on.append(1.0 / (1.0 + np.exp(-s)) >= least)
            yield batch.filter(pa.array(on, pa.bool_()))
        # the worker goes on to other work, which has no use for these words
        _WORD.forget()
        _SHAPE.forget()

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id):
    """Rows whose labels are never learned from."""
    return crc_part(doc_id, 3) == 1
