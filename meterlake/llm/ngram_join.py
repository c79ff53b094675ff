"""N-gram Jaccard join: documents whose sets of word 5-grams are similar, by a blocked sparse product.

The incidence matrix has a row for each distinct set and a column for each gram.
Its columns are put in one order, commonest grams last, and cut in two blocks. The
first holds of each row the least number of columns that two rows of the wanted
similarity must share one of (it follows from the row's size). The product of that
block with itself is a join on grams; entries that the rows' sizes and the places
of the shared gram rule out are dropped at once. For the entries that remain the
overlap is completed over the rest of the columns.

Large groups of near copies never give all their pairs. A first product pairs each
gram's rows with one of them alone, and the links found are closed to components; a
second does so with a few other rows. The last product pairs rows of different
components only, which finds every link that can still change a component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.components import components
from meterlake.llm.shared import OUT_BYTES, Bitmap, commonest, fresh, materialize, release, texts
from meterlake.llm.words import distinct, shingles, together, word_hashes, words_together

#: Words of a gram, and the least similarity in percent.
GRAM = 5
PERCENT = 80
#: The order of columns: grams are counted in one of ORDER_SHARE documents, and the
#: ORDER_SIZE commonest come last. The order decides how much work a row takes and
#: never which links are found.
ORDER_SHARE = 16
ORDER_SIZE = 2**17
#: Rows of a gram that its other rows pair with before all open pairs are made, where
#: these are more than so many for each open row.
STAR_HUBS, FEW = 8, 8

def gram_sets(rows: Iterable[tuple]) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, distinct grams, sorted) of rows (id, text), hashed many at a time."""
    for ids, group in together(rows):
        words, n = words_together(group)
        grams = shingles(words, GRAM)
        for row_id, end, size in zip(ids, np.cumsum(n).tolist(), n.tolist()):
            own = grams[end - size : end - GRAM + 1] if size >= GRAM else shingles(words[end - size : end], GRAM)
            yield row_id, distinct(own)


def set_id(grams: np.ndarray) -> int:
    """64-bit hash of a set, signed: equal sets are one row of the matrix."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))


def least_overlap(a, b):
    """Grams that sets of sizes a and b must share: 100 * o >= PERCENT * (a + b - o)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix_size(n: int) -> int:
    """Of a set of n grams, how many hold one that any similar set shares.

    A similar set shares at least PERCENT % of the n grams.
    """
    return n - -(-PERCENT * n // 100) + 1


class Order:
    """Columns in order: the commonest grams last, rarest of them first; else by hash."""

    def __init__(self, common: np.ndarray):
        """common: the common grams, rarest first."""
        self.at = np.argsort(common)
        self.sorted = common[self.at]

    def of(self, grams: np.ndarray) -> np.ndarray:
        """The grams (sorted by hash) in order."""
        if not len(self.sorted) or not len(grams):
            return grams
        place = np.searchsorted(self.sorted, grams)
        place[place == len(self.sorted)] = 0
        common = self.sorted[place] == grams
        late = grams[common]
        return np.concatenate([grams[~common], late[np.argsort(self.at[place[common]], kind="stable")]])


def common_grams(docs: DataFrame) -> np.ndarray:
    """The commonest grams of a share of the documents, rarest first: a table of fixed size."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [grams for _, grams in gram_sets(texts(batch))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64) if parts else [], pa.int64())], ["gram"])

    share = docs.where(F.pmod(F.xxhash64("text"), F.lit(ORDER_SHARE)) == 0)
    counts = share.mapInArrow(grams, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where("n > 2")
    counts = materialize(counts, "jaccard-order")
    top = commonest(counts, "n", ORDER_SIZE)[0].toArrow().sort_by([("n", "ascending"), ("gram", "ascending")])
    release(counts)
    return top["gram"].to_numpy().view(np.uint64)


def similar_sizes(a: Column, b: Column) -> Column:
    return (100 * F.least(a, b)) >= (PERCENT * F.greatest(a, b))


def may_reach(a: str, b: str) -> Column:
    """Can two rows be similar whose first shared gram has these places (at) in rows of these sizes (n)?"""
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at"))
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    return similar_sizes(F.col(f"{a}.n"), F.col(f"{b}.n")) & ((100 + PERCENT) * rest >= PERCENT * both)


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, root, mark.

    Two documents link when their sets of GRAM-word grams overlap by PERCENT % of
    their union; ``component_id`` is the smallest id that links reach. A text of
    fewer words is one gram; without words, or null, the set is empty and links
    with nothing. Rows without an id link like others; a component of such rows
    alone has a null id. Rows that repeat an id each keep their row. ``root`` tells
    components apart and ``mark`` is a hash of the text. Sets and grams are held as 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    order = spark.sparkContext.broadcast(Order(common_grams(rows)))  # of fixed size

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [grams for _, grams in gram_sets(texts(batch))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) for s in sets], pa.int64()),
                ],
                ["doc_id", "mark", "n", "sid"],
            )

    marked = rows.withColumn("mark", F.xxhash64("text"))
    described = materialize(marked.mapInArrow(describe, "doc_id long, mark long, n long, sid long"), "jaccard-rows")

    def first_block(keep: Bitmap | None):
        """Rows of the first block: gram, set, its size, the gram's place, how many of the set's grams are left out; a set once a task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                parts: list[tuple[np.ndarray, int, int]] = []
                for _, grams in gram_sets(texts(batch)):
                    sid = set_id(grams)
                    if not len(grams) or sid in seen:
                        continue
                    seen.add(sid)
                    parts.append((order.value.of(grams)[: prefix_size(len(grams))], sid, len(grams)))
                if not parts:
                    continue
                sizes = [len(p[0]) for p in parts]
                gram = np.concatenate([p[0] for p in parts])
                sid = np.repeat(np.array([p[1] for p in parts], np.int64), sizes)
                n = np.repeat(np.array([p[2] for p in parts], np.int32), sizes)
                at = np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])
                alone = np.zeros(len(gram), dtype=np.int32)
                if keep is not None:
                    on = keep.value.has(gram)
                    alone = np.repeat(np.add.reduceat(~on, np.cumsum([0, *sizes[:-1]]), dtype=np.int32), sizes)
                    gram, sid, n, at, alone = gram[on], sid[on], n[on], at[on], alone[on]
                step = OUT_BYTES // 24
                for i in range(0, len(gram), step):
                    cols = [c[i : i + step] for c in (gram.view(np.int64), sid, n, at, alone)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["gram", "sid", "n", "at", "alone"])

        return rows.mapInArrow(run, "gram long, sid long, n int, at int, alone int")

    # grams of at least two sets, by two numbers a gram and task; the rest pairs with nothing
    shared = first_block(None).groupBy("gram").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low < high")
    shared = materialize(shared.select("gram", F.col("low").alias("hub")), "jaccard-shared")
    bits = spark.sparkContext.broadcast(Bitmap.of(shared, "gram", shared.count()))
    same = [F.first(c).alias(c) for c in ("n", "at", "alone", "hub")]
    block = materialize(first_block(bits).join(shared, "gram").groupBy("gram", "sid").agg(*same), "jaccard-block")
    bits.destroy()
    order.destroy()

    # product of each gram's rows with one of them
    hubs = block.where("sid = hub").select("gram", "sid", "n", "at")
    first = block.where("sid <> hub").alias("a").join(hubs.alias("b"), F.col("a.gram") == F.col("b.gram")).where(may_reach("a", "b"))
    tested = materialize(first.select(F.greatest("a.sid", "b.sid").alias("a"), F.least("a.sid", "b.sid").alias("b")).distinct(), "jaccard-pairs")
    links = verified(tested, block, rows, described)
    roots = components(links)

    def open_now() -> DataFrame:
        """Rows of grams that still join different components, with their component."""
        placed = block.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        mixed = placed.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        return materialize(placed.join(mixed.select("gram"), "gram").select("gram", "sid", "n", "at", "alone", "root"), "jaccard-open")

    def extend(found: DataFrame) -> DataFrame:
        return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))

    # the same with a few other rows at once, the same for many grams: linear, and merges most of what can be merged.
    # A row with few grams of its own is the likeliest to be similar to others.
    rest = open_now()
    if pairs_each(rest) > FEW:
        rank = lambda k: (F.col("alone") + 1) * (500 + F.pmod(F.xxhash64("sid", F.lit(k)), F.lit(1000)))
        first = [F.min(F.struct(rank(k).alias("rank"), "sid", "n", "at", "root")) for k in range(STAR_HUBS)]
        hubs = rest.groupBy("gram").agg(F.array(*first).alias("hubs"), F.count("*").alias("rows")).where(F.col("rows") > FEW)
        hubs = hubs.select("gram", F.explode("hubs").alias("hub")).select("gram", *[F.col(f"hub.{c}").alias(c) for c in ("sid", "n", "at", "root")])
        met = rest.alias("a").join(hubs.alias("b"), F.col("a.gram") == F.col("b.gram"))
        pairs = materialize(untested(met.where((F.col("a.root") != F.col("b.root")) & may_reach("a", "b")), tested), "jaccard-pairs")
        found = verified(pairs, block, rows, described)
        tested = tested.unionByName(pairs)
        if not found.isEmpty():
            roots = extend(found)
            release(rest)
            rest = open_now()

    # product over all rows of different components: a gram's largest component against its other rows, and those
    # against each other
    most = rest.groupBy("gram", "root").agg(F.count("*").alias("k")).groupBy("gram").agg(F.max(F.struct("k", "root")).alias("most"))
    most = most.select(F.col("gram").alias("of"), F.col("most.root").alias("main"))
    minor = rest.join(most, (F.col("gram") == F.col("of")) & (F.col("root") != F.col("main"))).alias("a")
    across = F.col("a.root") != F.col("b.root")
    once = (F.col("b.root") == F.col("a.main")) | (F.col("a.sid") < F.col("b.sid"))
    met = minor.join(rest.alias("b"), (F.col("a.gram") == F.col("b.gram")) & across & once & may_reach("a", "b"))
    more = verified(untested(met, tested), block, rows, described)
    final = extend(more).withColumnRenamed("node", "sid")
    release(links, more, rest, block, shared)

    # a document's component: the smallest id of all its sets
    with_root = described.join(final, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = with_root.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = with_root.join(least, "root", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        "root",
        "mark",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: of the smallest id (nulls last), then of the smallest hash of its text.

    Texts without words are each a component of their own; only rows that repeat
    both id and text go then.
    """
    found = jaccard_components(docs, id_col, text_col)
    empty = F.col("n_shingles") == 0
    group = [F.when(~empty, F.col("root")), F.when(empty, F.col("doc_id")), F.when(empty, F.col("mark")), empty]
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    kept = found.groupBy(*[c.alias(f"g{i}") for i, c in enumerate(group)]).agg(F.min(order).alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("_kept_id"), F.col("first.mark").alias("_kept_mark")).distinct()
    mark = fresh(docs, "mark")
    marked = docs.withColumn(mark, F.xxhash64(docs[text_col].cast("string")))
    own = marked[id_col].cast("long")
    kept = kept.select(F.col("_kept_id").alias(fresh(marked, "kept_id")), F.col("_kept_mark").alias(fresh(marked, "kept_mark")))
    same = (marked[mark] == kept[kept.columns[1]]) & own.eqNullSafe(kept[kept.columns[0]])
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, mark]).drop(mark)


def gather_sets(rows: DataFrame, wanted: DataFrame, count: int, described: DataFrame) -> DataFrame:
    """(sid, grams) of the wanted sets (``count`` rows, which may repeat), each once, written.

    ``described`` gives the texts of each set by their hashes; a bitmap of those hashes
    leaves out nearly all other texts before they are cut into grams.
    """
    marks = described.join(wanted, "sid", "left_semi").select("mark")
    bits = rows.sparkSession.sparkContext.broadcast(Bitmap.of(marks, "mark", count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(bits.value.has(batch.column(2).to_numpy())))
            sids, sets, size = [], [], 0
            for _, grams in gram_sets(texts(batch)):
                sid = set_id(grams)
                if sid in seen:
                    continue
                seen.add(sid)
                sids.append(sid)
                sets.append(grams.tobytes())
                size += grams.nbytes
                if size > OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], ["sid", "grams"])
                    sids, sets, size = [], [], 0
            if sids:
                yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(sets, pa.binary())], ["sid", "grams"])

    found = rows.withColumn("mark", F.xxhash64("text")).mapInArrow(run, "sid long, grams binary")
    out = materialize(found.join(wanted, "sid", "left_semi").dropDuplicates(["sid"]), "jaccard-sets")
    bits.destroy()
    return out


def pairs_each(rest: DataFrame) -> float:
    """How many pairs, at most, the product over all rows of different components makes for each open row."""
    by_root = rest.groupBy("gram", "root").agg(F.count("*").alias("k"))
    by_gram = by_root.groupBy("gram").agg(F.sum("k").cast("double").alias("n"), F.max("k").alias("main"))
    row = by_gram.agg(F.sum("n").alias("rows"), F.sum((F.col("n") - F.col("main")) * F.col("n")).alias("pairs")).first()
    return row["pairs"] / row["rows"] if row["rows"] else 0.0


def untested(met: DataFrame, tested: DataFrame) -> DataFrame:
    """The distinct pairs of a joined with b that were not tested yet, larger id first."""
    pairs = met.select(F.greatest("a.sid", "b.sid").alias("a"), F.least("a.sid", "b.sid").alias("b")).distinct()
    return pairs.join(tested, ["a", "b"], "left_anti")


def likely(pairs: DataFrame, block: DataFrame) -> DataFrame:
    """The pairs whose overlap in the first block leaves them able to reach the least overlap.

    Take the set whose prefix ends first in the order of columns. Grams shared up
    to there are in both prefixes and counted; beyond, it has no more than its own
    rest, one less than PERCENT % of its size. ``block`` lacks grams of one set
    alone, which do not count.
    """
    held = block.groupBy("sid").agg(F.collect_list("gram").alias("grams"), F.first("n").alias("n"))
    left = held.select(F.col("sid").alias("a"), F.col("grams").alias("left"), F.col("n").alias("na"))
    right = held.select(F.col("sid").alias("b"), F.col("grams").alias("right"), F.col("n").alias("nb"))
    both = pairs.join(left, "a").join(right, "b")
    rest = F.expr(f"({PERCENT} * greatest(na, nb) + 99) div 100 - 1")
    most = F.size(F.array_intersect("left", "right")) + rest
    return both.where((100 + PERCENT) * most >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b")


def verified(pairs: DataFrame, block: DataFrame, rows: DataFrame, described: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets overlap enough, written."""
    pairs = materialize(likely(pairs, block), "jaccard-likely")
    count = pairs.count()  # from the footers of what was written
    if not count:
        return pairs
    sets = gather_sets(rows, pairs.select("a").union(pairs.select("b")).withColumnRenamed("a", "sid"), 2 * count, described)
    left = sets.select(F.col("sid").alias("a"), F.col("grams").alias("left"))
    right = sets.select(F.col("sid").alias("b"), F.col("grams").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                on.append(both >= least_overlap(len(s), len(t)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(on, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    links = materialize(joined.mapInArrow(run, "a long, b long"), "jaccard-links")
    release(pairs, sets)
    return links
