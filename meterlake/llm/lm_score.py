"""Language-model scores by deleted interpolation of word n-grams.

The model mixes three maximum-likelihood estimates of the next token: after its
context (the token before), by itself, and uniform. The mixture weights depend on
how often the context was seen, in buckets by powers of two, and are learned by
expectation-maximisation: one tenth of the training documents is held out, its
counts are deleted from the estimates, and the weights maximise the likelihood of
the held-out counts; the final estimates use all training counts.

Every training word is a token, as a context and after one, and every pair counts,
also one seen once; a word that training lacks is the token OTHER. The commonest
words have small numbers, all others a hash. Counts of words and of token pairs
grow with the corpus and stay with Spark: the commonest (tables of fixed size) are
a cache in the tasks, all others meet their exact counts in joins. What a learned
text has and neither the cache nor the bitmap of counts above 1 holds occurs once,
in that text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import Bitmap, commonest, crc_part, materialize, narrow, release, texts
from meterlake.llm.words import mix, spark_hash

#: Words that have small numbers as tokens; more words and pairs whose counts the tasks have at hand, by hash.
HOT_WORDS = VOCABULARY = 2**17
MORE_WORDS = 2**20
HOT_PAIRS = 2**20
#: Pairs seen so often in training have an estimate of their own: all.
LEAST_PAIR = 1
#: Smoothing of word counts.
ADD = 0.1
#: Expectation-maximisation ends when no weight moves more than this, or after so many steps.
EM_CLOSE, EM_STEPS = 1e-3, 200
#: Buckets of context counts by powers of two, beyond any count.
BUCKETS = 64
#: Entries of a task's tables of partial counts, token pairs that are counted at once, bytes of text that are scored at once.
PARTIAL = 300_000
PAIRS_AT_ONCE = 3_000_000
CHUNK = 1_000_000

# Numbers of the tokens that are not hot words; all other words have negative numbers.
OTHER, END = VOCABULARY, VOCABULARY + 1
START = VOCABULARY + 2  # as a context alone
SIDE = VOCABULARY + 3


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def bucket(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then by powers of two."""
    return np.minimum(BUCKETS - 1, np.ceil(np.log2(counts + 1))).astype(np.int64)


def training(doc_id):
    return crc_part(doc_id, 10) != 0


def held_out(doc_id):
    """Of the training texts, those that the weights are learned from."""
    return crc_part(doc_id, 10) == 1


@dataclass
class Words:
    """Counts of the training words: what tasks need of them."""

    number: dict[bytes, int]  # of the hot words, commonest first
    tokens: np.ndarray  # counts by token: hot words, OTHER, END
    held: np.ndarray  # the part of them in held-out texts
    more: np.ndarray  # hashes of further words, sorted, and their counts
    more_n: np.ndarray
    documents: int
    held_documents: int
    kinds: int  # V, with the end
    total: int  # N, with the ends
    held_total: int

    @property
    def uniform(self) -> float:
        """Over all training words, OTHER and the end."""
        return 1.0 / (self.words + 2)

    @property
    def words(self) -> int:
        return self.kinds - (self.tokens[END] > 0)

    def contexts(self, held: bool = False) -> np.ndarray:
        """How often each small number is a context: a word as often as it comes, START once a text."""
        out = (self.held if held else self.tokens).copy()
        out[END], out[START] = 0, self.held_documents if held else self.documents
        return out


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n, held) over the training texts, and the part in held-out texts; tasks add up first."""
    rows = train.withColumn("out", held_out(F.col("doc_id")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for (_, text), out in zip(texts(batch), batch.column(2).to_pylist()):
                seen[bool(out)].update(tokens(text))
                if len(seen[0]) + len(seen[1]) >= PARTIAL:
                    yield from as_batches(seen)
                    for part in seen:
                        part.clear()
        yield from as_batches(seen)

    def as_batches(seen: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        for out, part in enumerate(seen):
            n = pa.array(list(part.values()), pa.int64())
            held = n if out else pa.array(np.zeros(len(part), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(list(part), pa.binary()), n, held], ["word", "n", "held"])

    return rows.mapInArrow(count, "word binary, n long, held long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))


def cold_words(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, id, n, held) of the words that are not hot: those at hand in the tasks, and all others."""
    rest = commonest(counts, "n", HOT_WORDS)[1]
    return commonest(rest.select(F.xxhash64("word").alias("key"), F.expr("xxhash64(word) | shiftleft(1L, 63)").alias("id"), "n", "held"), "n", MORE_WORDS)


def gather_words(counts: DataFrame, documents: int, held_documents: int, more: DataFrame | None = None) -> Words:
    """counts: the table of word_counts, written; ``more``: the first part of cold_words."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    row = counts.agg(F.count("*").alias("kinds"), total("n"), total("held")).first()
    top = commonest(counts, "n", HOT_WORDS)[0].toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    by_token, held = np.zeros(SIDE, dtype=np.int64), np.zeros(SIDE, dtype=np.int64)
    by_token[: len(top)], held[: len(top)] = top["n"].to_numpy(), top["held"].to_numpy()
    by_token[END], held[END] = documents, held_documents
    number = {w: i for i, w in enumerate(top["word"].to_pylist())}
    none = np.empty(0, np.int64)
    far = more.select("id", "n").toArrow().sort_by("id") if more is not None else {"id": none, "n": none}
    ids, n = (np.asarray(far[c]) for c in ("id", "n"))  # of fixed size
    kinds = row["kinds"] + (documents > 0)
    return Words(number, by_token, held, ids, n, documents, held_documents, kinds, row["n"] + documents, row["held"] + held_documents)


def word_id(word: bytes) -> int:
    """The token of a word that is not hot: a hash below zero."""
    return (xxhash.xxh64_intdigest(word, seed=42) | 1 << 63) - (1 << 64)


def pairs_of(found: list[list[bytes]], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token pairs of some texts, each from START to END: contexts, the tokens after them, and the text's place."""
    size = np.array([len(words) for words in found], dtype=np.int64)
    words = list(chain.from_iterable(found))
    rank = np.fromiter(map(number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
    cold = np.flatnonzero(rank < 0)
    far = np.fromiter(map(xxhash.xxh64_intdigest, map(words.__getitem__, cold.tolist()), repeat(42)), dtype=np.uint64, count=len(cold))
    rank[cold] = (far | np.uint64(1 << 63)).view(np.int64)
    ids = np.full(len(words) + 2 * len(found), START, dtype=np.int64)
    ids[np.arange(len(words)) + 2 * np.repeat(np.arange(len(found)), size) + 1] = rank
    ids[np.cumsum(size + 2) - 1] = END
    return ids[ids != END], ids[ids != START], np.repeat(np.arange(len(found)), size + 1)


def pair_id(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """context * SIDE + token of small numbers, a hash below zero of others."""
    with np.errstate(over="ignore"):
        mixed = mix(mix(context.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + token.view(np.uint64)) | np.uint64(1 << 63)
        return np.where((context < 0) | (token < 0), mixed.view(np.int64), context * SIDE + token)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]], np.ndarray]]:
    """Of rows (doc_id, text, mark): ids, words and marks of some texts at a time, whole texts and about CHUNK bytes."""
    for batch in batches:
        ids, found, marks, size = [], [], [], 0
        for (doc_id, text), mark in zip(texts(batch), batch.column(2).to_pylist()):
            ids.append(doc_id)
            found.append(tokens(text))
            marks.append(bool(mark))
            size += len(text)
            if size >= CHUNK:
                yield ids, found, np.array(marks)
                ids, found, marks, size = [], [], [], 0
        if ids:
            yield ids, found, np.array(marks)


def pair_counts(train: DataFrame, words: Words, held) -> DataFrame:
    """(pair, n, held) over the training texts: the count of each token pair, and its part in held-out texts."""
    shipped = train.sparkSession.sparkContext.broadcast(words.number)
    rows = train.withColumn("held", held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        size = 0
        for _, found, out in chunks(batches):
            context, token, of = pairs_of(found, shipped.value)
            parts.append((pair_id(context, token), out[of]))
            size += len(of)
            if size >= PAIRS_AT_ONCE:
                yield as_batch(parts)
                parts, size = [], 0
        if parts:
            yield as_batch(parts)

    def as_batch(parts: list[tuple]) -> pa.RecordBatch:
        pairs, out = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(pairs)
        pairs = pairs[order]
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        n = np.diff(np.append(first, len(pairs)))
        h = np.add.reduceat(out[order].astype(np.int64), first)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (pairs[first], n, h)], ["pair", "n", "held"])

    return rows.mapInArrow(count, "pair long, n long, held long").groupBy("pair").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))


def sides_of(rows: DataFrame, words: Words) -> DataFrame:
    """(pair, context, token), each once, of the pairs with a word that is not hot."""
    shipped = rows.sparkSession.sparkContext.broadcast(words.number)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found, _ in chunks(batches):
            context, token, _ = pairs_of(found, shipped.value)
            far = (context < 0) | (token < 0)
            context, token = context[far], token[far]
            pairs, first = np.unique(pair_id(context, token), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (pairs, context[first], token[first])], ["pair", "context", "token"])

    found = rows.withColumn("mark", F.lit(True)).mapInArrow(sides, "pair long, context long, token long")
    return found.groupBy("pair").agg(F.min("context").alias("context"), F.min("token").alias("token"))


def with_counts(rows: DataFrame, cold: DataFrame, n: str = "n") -> DataFrame:
    """rows with ``context_n`` and ``token_n``: ``n`` of the words of negative numbers that cold has, else what the rows have."""
    for side in ("context", "token"):
        found = cold.select(F.col("id").alias("cold"), F.expr(n).alias("found"))
        # small numbers meet nothing: they are spread out, not gathered by word; a hash travels once
        key = F.when(F.col(side) < 0, F.col(side)).otherwise(F.xxhash64(*rows.columns).bitwiseAND(2**20 - 1))
        rows = rows.withColumns({"cold": key, side: F.greatest(F.col(side), F.lit(-1))}).join(found, "cold", "left")
        rows = rows.withColumn(f"{side}_n", F.coalesce("found", f"{side}_n")).drop("cold", "found")
    return rows


def learn_weights(pairs: DataFrame, words: Words, sides: DataFrame | None = None, cold: DataFrame | None = None) -> np.ndarray:
    """Mixture weights (BUCKETS x 3: pair, token, uniform) by EM on the held-out counts.

    Each step is one aggregate over the held-out pairs, equal estimates together:
    the sums of responsibilities, a row for each bucket. ``sides`` has the tokens of
    the held-out pairs with a word that is not hot, ``cold`` (id, n, held) of those
    words. A bucket without held-out counts keeps its first weights; an unseen
    context gives the pair none.
    """
    spark = pairs.sparkSession
    kept = words.contexts() - words.contexts(held=True)
    left = words.tokens - words.held
    all_n = max(1, words.total - words.held_total)
    shipped = spark.sparkContext.broadcast((kept, left))  # of fixed size
    uniform = words.uniform
    nothing = F.lit(0).cast("long")
    held = pairs.where("held > 0").withColumns({"context_n": nothing, "token_n": nothing})
    near = held.where("pair >= 0").withColumns({"context": F.expr(f"pair div {SIDE}L"), "token": F.expr(f"pair % {SIDE}L")})
    cols = ["context", "token", "n", "held", "context_n", "token_n"]
    rows = near.select(cols)
    if sides is not None:
        far = held.where("pair < 0").join(sides, "pair").select(cols)
        rows = rows.unionByName(with_counts(far, cold.where("n > held"), "n - held").select(cols))

    def estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context_n, token_n = shipped.value
        for batch in batches:
            context, token, n, out, far_context, far_token = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            seen = np.where(context < 0, far_context, context_n[np.maximum(0, context)])
            of_token = np.where(token < 0, far_token, token_n[np.maximum(0, token)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket(seen)), pa.array((n - out) / np.maximum(1, seen)), pa.array(of_token / all_n), pa.array(out, pa.int64())],
                ["bucket", "p2", "p1", "held"],
            )

    rows = rows.mapInArrow(estimates, "bucket long, p2 double, p1 double, held long").groupBy("bucket", "p2", "p1").agg(F.sum("held").alias("held"))
    rows = materialize(rows, "lm-held")
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    for _ in range(EM_STEPS):
        # a table of BUCKETS rows: as literals, each step would be compiled anew
        w = spark.createDataFrame([(k, *map(float, line)) for k, line in enumerate(weights)], "bucket long, w2 double, w1 double, w0 double")
        a, b, c = F.col("w2") * F.col("p2"), F.col("w1") * F.col("p1"), F.col("w0") * uniform
        share = F.col("held") / (a + b + c)
        sums = (
            rows.join(F.broadcast(w), "bucket")
            .groupBy("bucket")
            .agg(F.sum(a * share).alias("a"), F.sum(b * share).alias("b"), F.sum(c * share).alias("c"))
            .collect()  # BUCKETS rows at most
        )
        before = weights.copy()
        for r in sums:
            part = np.array([r["a"], r["b"], r["c"]])
            weights[r["bucket"]] = part / part.sum()
        if np.abs(weights - before).max() <= EM_CLOSE:
            break
    release(rows)
    shipped.unpersist()
    # every token stays possible
    weights = np.maximum(weights, 1e-6)
    weights[0, 0] = 0.0
    return weights / weights.sum(axis=1, keepdims=True)


@dataclass
class Model:
    words: Words
    weights: np.ndarray
    context: np.ndarray  # how often the small numbers are contexts
    hot: np.ndarray  # commonest pairs, sorted, and their counts
    hot_n: np.ndarray

    def probability(self, pair: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of pairs of small numbers that training has n times."""
        context, token = pair // SIDE, pair % SIDE
        return self.mixed(n, self.context[context], self.words.tokens[token])

    def mixed(self, n: np.ndarray, seen: np.ndarray, token_n: np.ndarray) -> np.ndarray:
        """From the counts of a pair, of its context and of its token."""
        w = self.weights[bucket(seen)]
        return w[:, 0] * n / np.maximum(1, seen) + w[:, 1] * token_n / max(1, self.words.total) + w[:, 2] * self.words.uniform


def found_in(table: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the sorted table has each key, and its count there."""
    if not len(table):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    order = np.argsort(keys)  # neighbours are looked up near one another
    at = np.empty(len(keys), np.int64)
    at[order] = np.minimum(np.searchsorted(table, keys[order]), len(table) - 1)
    return table[at] == keys, counts[at]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    Training texts are those whose crc32(id as text) modulo 10 is not 0; rows
    without an id are scored, not learned from, and not held out. A null text is
    empty: its one token is the end. Repeated rows count as often as they come
    and are each scored. Without training texts the base score is that of an empty
    vocabulary and the mixture is uniform.
    """
    spark = docs.sparkSession
    rows = narrow(docs, id_col, text_col)
    train = rows.where(training(F.col("doc_id")))
    held = held_out(F.col("doc_id"))
    sizes = train.agg(F.count("*").alias("n"), F.coalesce(F.sum(held.cast("long")), F.lit(0)).alias("held")).first()
    counts = materialize(word_counts(train), "lm-words")
    more, cold = cold_words(counts)
    words = gather_words(counts, sizes["n"], sizes["held"], more)
    pairs = materialize(pair_counts(train, words, held), "lm-pairs")
    weights = learn_weights(pairs, words, sides_of(train.where(held), words), more.unionByName(cold))
    hot, rest = commonest(pairs.select("pair", "n"), "n", HOT_PAIRS)
    top = hot.toArrow().sort_by("pair")  # of fixed size
    model = Model(words, weights, words.contexts(), top["pair"].to_numpy(), top["n"].to_numpy())
    often = rest.where("n > 1").select(F.xxhash64("pair").alias("key"))
    pair_bits = Bitmap.of(often, "key", often.count())
    twice = cold.where("n > 1")
    word_bits = Bitmap.of(twice, "key", twice.count())
    shipped = spark.sparkContext.broadcast((model, pair_bits, word_bits))  # tables of bounded size

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return score_batches(batches, *shipped.value)

    parts = rows.withColumn("learned", training(F.col("doc_id"))).mapInArrow(local, _PARTS)
    parts = materialize(parts.withColumn("row", F.monotonically_increasing_id()), "lm-parts")
    one = lambda names: parts.select("row", "learned", F.explode(F.arrays_zip(*names)).alias("x")).select("row", "learned", *[f"x.{c}" for c in names])

    # pairs seen once matter to texts that were not learned alone
    asked = parts.where("NOT learned").select(F.explode(F.concat("small_pairs", "pairs", "far_pairs")).alias("pair")).select(F.xxhash64("pair").alias("key"))
    asked_bits = spark.sparkContext.broadcast(Bitmap.of(asked, "key", asked.count()))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(asked_bits.value.has(spark_hash(batch.column(0).to_numpy()))))

    known = rest.where("n > 1").unionByName(rest.where("n = 1").mapInArrow(wanted, rest.schema)).withColumnRenamed("n", "found")
    known = materialize(known, "lm-known")
    release(pairs)
    asked_bits.unpersist()
    # where the join finds no count, a learned text's own one holds
    own_n = F.col("learned").cast("long").alias("n")
    count = lambda asked, on: asked.join(known.where(on), "pair", "left").withColumn("n", F.coalesce("found", "n")).drop("found")
    small = count(parts.select("row", own_n, F.explode("small_pairs").alias("pair")), "pair >= 0").select("row", "n", "pair")
    near = count(one(["pairs", "context_n", "token_n"]).select("row", own_n, F.col("pairs").alias("pair"), "context_n", "token_n"), "pair < 0")
    far = one(["far_pairs", "far_n", "context", "token", "far_context_n", "far_token_n"]).drop("learned")
    far = far.toDF("row", "pair", "n", "context", "token", "context_n", "token_n")
    # a pair whose count the task knew is 0 there
    far = far.where("pair = 0").drop("pair").unionByName(count(far.where("pair < 0"), "pair < 0").drop("pair"))
    cols = ["row", "n", "context_n", "token_n"]

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, *counted = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            m = shipped.value[0]
            p = m.probability(counted[1], counted[0]) if batch.schema.names[-1] == "pair" else m.mixed(*counted)
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.log10(p))], ["row", "own"])

    priced = lambda met: met.mapInArrow(price, "row long, own double").select(
        "row", F.lit(0.0).alias("base"), "own", F.lit(0).cast("long").alias("known")
    )
    far_words = parts.select("row", F.explode("words").alias("id")).join(cold.select("id", "n"), "id", "left")
    seen = F.coalesce(F.col("n"), F.lit(0))
    by_word = far_words.select("row", F.log10(seen + ADD).alias("base"), F.lit(0.0).alias("own"), (seen > 0).cast("long").alias("known"))
    add_up = lambda found: found.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("base", "own", "known")])
    # one join after the other, so that the shuffle files of one are gone before the next
    met = [priced(small), priced(near.select(cols)), priced(with_counts(far, cold).select(cols)), by_word]
    met = [materialize(add_up(found), "lm-sums") for found in met]
    release(known, counts)
    shipped.unpersist()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    sums = add_up(reduce(DataFrame.unionByName, met)).toDF("row", "far_base", "far_own", "far_known")
    out = parts.select("row", "doc_id", "n_tokens", "known", "base", "own").join(sums, "row", "left").select(
        "doc_id",
        F.coalesce(crc_part(F.col("doc_id"), 10) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("known") + zero("far_known")).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("far_base")).alias("base_score"),
        (F.col("own") + zero("far_own")).alias("score"),
    )
    scores = materialize(out, "lm-scores")
    release(parts, *met)
    return scores


_PARTS = (
    "doc_id long, learned boolean, n_tokens long, known long, base double, own double, words array<bigint>, "
    "small_pairs array<bigint>, pairs array<bigint>, context_n array<bigint>, token_n array<bigint>, far_pairs array<bigint>, far_n array<bigint>, "
    "context array<bigint>, token array<bigint>, far_context_n array<bigint>, far_token_n array<bigint>"
)


def score_batches(batches: Iterator[pa.RecordBatch], m: Model, pair_bits: Bitmap, word_bits: Bitmap) -> Iterator[pa.RecordBatch]:
    """A row for each document: the sums over what the task knows, and the words and pairs whose counts are elsewhere.

    A word or pair of a learned text that is neither at hand nor in the bitmap
    occurs once. The counts are what holds where the join finds none. Pairs of small
    numbers go alone: they tell their words, whose counts the tasks have.
    """
    w = m.words
    bottom = np.log10(w.total + ADD * (w.kinds + 1))

    def counted(ids: np.ndarray, small: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words, as far as they are at hand, and where they are elsewhere."""
        n, away = small[np.maximum(0, ids)], np.zeros(len(ids), bool)
        cold = np.flatnonzero(ids < 0)
        here, n_here = found_in(w.more, w.more_n, ids[cold])
        n[cold] = np.where(here, n_here, learned[cold])
        away[cold] = ~here & (~learned[cold] | word_bits.has(ids[cold].view(np.uint64)))
        return n, away

    for doc_id, found, learned in chunks(batches):
        context, token, of = pairs_of(found, w.number)
        own_text = learned[of]
        pair = pair_id(context, token)
        near, n = found_in(m.hot, m.hot_n, pair)
        n = np.where(near, n, own_text)
        away = ~near & ~own_text
        unsure = np.flatnonzero(~near & own_text)
        away[unsure] = pair_bits.has(spark_hash(pair[unsure]))
        token_n, token_away = counted(token, w.tokens, own_text)
        context_n, context_away = counted(context, m.context, own_text)
        side_away = token_away | context_away
        here = ~away & ~side_away
        total = lambda on, x: np.bincount(of[on], weights=x, minlength=len(found))
        own = total(here, np.log10(m.mixed(n[here], context_n[here], token_n[here])))
        sure = ~token_away
        base = total(sure, np.log10(token_n[sure] + ADD)) - np.bincount(of, minlength=len(found)) * bottom
        known = np.bincount(of[sure & (token_n > 0)], minlength=len(found))

        def lists(on: np.ndarray, *cols: np.ndarray) -> list[pa.Array]:
            ends = np.concatenate([[0], np.cumsum(np.bincount(of[on], minlength=len(found)))]).astype(np.int32)
            return [pa.ListArray.from_arrays(ends, pa.array(c[on], pa.int64())) for c in cols]

        small = lambda ids, on: np.where(on, ids, 0)
        cols = [pa.array(doc_id, pa.int64()), pa.array(learned), pa.array(np.bincount(of, minlength=len(found)), pa.int64()), pa.array(known, pa.int64())]
        cols += [pa.array(base), pa.array(own), *lists(token_away, token), *lists(away & (pair >= 0), pair)]
        cols += lists(away & ~side_away & (pair < 0), pair, context_n, token_n)
        cols += lists(side_away, small(pair, away), n, small(context, context_away), small(token, token_away), context_n, token_n)
        yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in _PARTS.split(", ")])
