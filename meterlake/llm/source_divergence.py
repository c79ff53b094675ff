"""How far the sources of each language are from one another, and the terms that set a source apart.

Equal texts of a language are collapsed first: tasks combine their rows to one per
(lang, text) with the number of copies by source, one shuffle brings the rest
together, and each distinct text is split into terms once; its counts and document
frequencies are weighted by the copies. Pairs of sources are then evaluated
sparsely: a term that only one of two sources has costs nothing for the pair, since
such terms enter by a histogram of the source's counts and terms of neither source
by their number.

All arithmetic is on integers, so results do not depend on the order of rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.shared import materialize, release

# Fixed values of the measure.
LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10

#: Bytes of texts that a task holds while it combines equal ones, and term counts it holds before it hands them on.
HELD_BYTES = 48_000_000
HELD_TERMS = 300_000
#: Pairs of sources whose sums a task holds.
HELD_PAIRS = 500_000

#: Letters A-Z in lower case, a-z and all bytes of other code points stay; the rest splits terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


TEXTS = "lang string, text string, h long, sources array<string>, copies array<bigint>"
TERMS = "lang string, term string, source string, n long, docs long"


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text, h) rows to one row per (lang, text) held at a time, with the copies by source."""
    held: dict[tuple, Counter] = {}
    size = 0

    def out():
        langs, texts, hashes = zip(*held)
        arrays = [
            pa.array(langs, pa.string()),
            pa.array(texts, pa.string()),
            pa.array(hashes, pa.int64()),
            pa.array([list(c) for c in held.values()], pa.list_(pa.string())),
            pa.array([list(c.values()) for c in held.values()], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "text", "h", "sources", "copies"])

    for batch in batches:
        columns = [batch.column(i) for i in range(4)]
        for lang, source, text, h in zip(*[c.to_pylist() for c in columns]):
            sources = held.get((lang, text, h))
            if sources is None:
                sources = held[lang, text, h] = Counter()
                size += len(text) + 100
            sources[source] += 1
            if size >= HELD_BYTES:
                yield out()
                held.clear()
                size = 0
    if held:
        yield out()


class _TermCounts:
    """Counts and document frequencies by (source, term) of one language; gives rows when it holds many."""

    def __init__(self):
        self.n: dict[str, Counter] = {}
        self.docs: dict[str, Counter] = {}
        self.lang: str | None = None

    def add(self, text: str, copies: dict[str, int]) -> None:
        terms = terms_of(text.encode())
        distinct = set(terms)
        for source, times in copies.items():
            n = self.n.setdefault(source, Counter())
            docs = self.docs.setdefault(source, Counter())
            if times == 1:
                n.update(terms)
                docs.update(distinct)
            else:
                for term, count in Counter(terms).items():
                    n[term] += times * count
                    docs[term] += times

    def size(self) -> int:
        return sum(map(len, self.n.values()))

    def batches(self) -> Iterator[pa.RecordBatch]:
        for source, n in self.n.items():
            if not n:
                continue
            docs = self.docs[source]
            arrays = [
                pa.array([self.lang], pa.string()).take(pa.array(np.zeros(len(n), dtype=np.int32))),
                pa.array(list(n), pa.binary()).cast(pa.string()),
                pa.array([source], pa.string()).take(pa.array(np.zeros(len(n), dtype=np.int32))),
                pa.array(list(n.values()), pa.int64()),
                pa.array([docs[t] for t in n], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "term", "source", "n", "docs"])
        self.n.clear()
        self.docs.clear()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (lang, text, h, sources, copies) sorted by (lang, h): equal texts meet, each is split once."""
    counts = _TermCounts()
    key, run = None, {}  # the texts of one hash, nearly always one
    since = 0

    def settle():
        for text, copies in run.items():
            counts.add(text, copies)
        run.clear()

    for batch in batches:
        for lang, text, h, sources, copies in zip(*[batch.column(i).to_pylist() for i in range(5)]):
            if (lang, h) != key:
                settle()
                since += 1
                if lang != counts.lang or since >= 64:
                    since = 0
                    if lang != counts.lang or counts.size() >= HELD_TERMS:
                        yield from counts.batches()
                        counts.lang = lang
                key = (lang, h)
            met = run.setdefault(text, Counter())
            for source, n in zip(sources, copies):
                met[source] += n
    settle()
    yield from counts.batches()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, term, source, n, docs) of all terms, in parts that are still to be summed up."""
    empty = F.lit("")
    rows = docs.select(
        F.coalesce(docs[lang_col].cast("string"), empty).alias("lang"),
        F.coalesce(docs[source_col].cast("string"), empty).alias("source"),
        F.coalesce(docs[text_col].cast("string"), empty).alias("text"),
    )
    rows = rows.where("text <> ''").withColumn("h", F.xxhash64("text"))
    met = rows.mapInArrow(_collapse, TEXTS).repartition("lang", "h").sortWithinPartitions("lang", "h")
    return met.mapInArrow(_count_terms, TERMS)


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS, **cols) -> DataFrame:
    """(lang, term, source, n, lang_n, first) of the terms in at least ``least`` documents of their language.

    lang_n is the term's count in the language; ``first`` marks one row of each term.
    """
    parts = term_counts(docs, **cols).repartition("lang", "term")
    summed = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")  # a row for each source
    found = summed.withColumns({"in_docs": F.sum("docs").over(own), "lang_n": F.sum("n").over(own), "least": F.min("source").over(own)})
    found = found.where(F.col("in_docs") >= least)
    return found.select("lang", "term", "source", "n", "lang_n", (F.col("source") == F.col("least")).alias("first"))


def rate(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)) of the named columns, exact at any count."""
    return F.expr(
        f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0))) div CAST({total} + 2 * {kept} AS DECIMAL(20,0))"
    )


def distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); both are at most SCALE + 1, so the square fits a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def group_totals(docs: DataFrame, kept: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, sid, total, terms, kept, lang_total, zero) of every occurring group; ``zero`` is the rate of a term it lacks.

    sid numbers the sources of a language; without kept terms ``zero`` is null.
    """
    names = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))]
    occurring = docs.select(*names).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    langs = own.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    sizes = kept.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    out = occurring.join(own, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang", "left")
    out = out.na.fill(0, ["total", "terms", "lang_total", "kept"])
    order = Window.partitionBy("lang").orderBy("source")  # a row for each source
    zero = F.when(F.col("kept") > 0, rate("0", "total", "kept"))
    return out.withColumns({"sid": F.row_number().over(order), "zero": zero})


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, term, sid, p, zero), those of a term together, to partial sums by pair of sources that share terms.

    A pair (s, t) of a term adds f(p_s, p_t) - f(p_s, zero_t) - f(zero_s, p_t) + f(zero_s, zero_t): what
    the pair's value differs by from that of two terms that the other source lacks.
    """
    sums: dict[str, dict[int, int]] = {}
    rest: pa.Table | None = None

    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    def add(lang: str, term: np.ndarray, sid: np.ndarray, p: np.ndarray, zero: np.ndarray) -> None:
        start = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        end = np.repeat(np.append(start[1:], len(term)), np.diff(np.append(start, len(term))))
        left = np.arange(len(term))
        keys, values, step = [], [], 1
        while len(left := left[left + step < end[left]]):
            right = left + step
            a, b = np.minimum(sid[left], sid[right]), np.maximum(sid[left], sid[right])
            keys.append(a << 32 | b)
            values.append(f(p[left], p[right]) - f(p[left], zero[right]) - f(zero[left], p[right]) + f(zero[left], zero[right]))
            step += 1
        if keys:
            key, value = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            held = sums.setdefault(lang, {})
            for k, v in zip(key[at].tolist(), np.add.reduceat(value, at).tolist()):
                held[k] = held.get(k, 0) + v

    def settle(table: pa.Table) -> None:
        langs = np.asarray(table["lang"].combine_chunks().dictionary_encode().indices)
        terms = np.asarray(table["term"].combine_chunks().dictionary_encode().indices)
        cols = [table[c].to_numpy().astype(np.int64) for c in ("sid", "p", "zero")]
        bounds = np.flatnonzero(np.concatenate([[True], langs[1:] != langs[:-1], [True]]))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            add(table["lang"][int(lo)].as_py(), terms[lo:hi], *[c[lo:hi] for c in cols])

    def out():
        for lang, held in sums.items():
            if held:
                key = np.fromiter(held.keys(), dtype=np.int64, count=len(held))
                arrays = [pa.array([lang] * len(held), pa.string()), pa.array((key >> 32).astype(np.int32)),
                          pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(list(held.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "s", "t", "value"])
        sums.clear()

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not len(table):
            continue
        # the last term may go on in the next batch
        last = (table["lang"][-1].as_py(), table["term"][-1].as_py())
        cut = len(table)
        while cut and (table["term"][cut - 1].as_py(), table["lang"][cut - 1].as_py()) == last[::-1]:
            cut -= 1
        if cut:
            settle(table.slice(0, cut))
        rest = table.slice(cut)
        if sum(map(len, sums.values())) >= HELD_PAIRS:
            yield from out()
    if rest is not None and len(rest):
        settle(rest)
    yield from out()


def pair_values(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, value) of each ordered pair of sources of a language."""
    spread = rated.select("lang", "term", "sid", "p", "zero").repartition("lang", "term").sortWithinPartitions("lang", "term")
    met = spread.mapInArrow(_meet, "lang string, s int, t int, value long")
    # terms of one source against the zero rate of another, by the source's distinct rates
    steps = rated.groupBy("lang", F.col("sid").alias("s"), "p").agg(F.count(F.lit(1)).alias("k"))
    others = groups.select("lang", F.col("sid").alias("t"), F.col("zero").alias("q"))
    one = steps.join(others, "lang").where("s <> t").select("lang", "s", "t", (F.col("k") * distance("p", "q")).alias("value"))
    parts = [met.groupBy("lang", "s", "t").agg(F.sum("value").alias("value")), one.groupBy("lang", "s", "t").agg(F.sum("value").alias("value"))]
    both = parts[0].unionByName(parts[1])
    both = both.unionByName(both.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), "value"))
    both = both.groupBy("lang", "s", "t").agg(F.sum("value").alias("met"))
    names = ["lang", "source", "sid", "terms", "zero", "kept"]
    left = groups.select(*names)
    right = groups.select("lang", *[F.col(c).alias(f"o_{c}") for c in names[1:-1]])
    pairs = left.join(right, "lang").where("sid <> o_sid")
    pairs = pairs.join(both.withColumnsRenamed({"s": "sid", "t": "o_sid"}), ["lang", "sid", "o_sid"], "left")
    neither = F.col("kept") - F.col("terms") - F.col("o_terms")
    value = F.coalesce(neither * distance("zero", "o_zero") + F.coalesce("met", F.lit(0)), F.lit(0))
    return pairs.select("lang", "source", F.col("o_source").alias("other"), value.alias("value"))


def audit_sources(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: every other source of the language (``pair``) and the ``top`` terms
    that a source has more often than its language (``term``), by value.

    A null text, language or source counts as empty. Repeated rows count as often as
    they occur. A source without terms has its pairs; a language without kept terms
    has pairs of value 0 and no terms. Values and order are exact and equal on each run.
    """
    kept = materialize(kept_terms(docs, least, text_col=text_col, lang_col=lang_col, source_col=source_col), "divergence-terms")
    groups = materialize(group_totals(docs, kept, lang_col, source_col), "divergence-groups")
    rated = kept.join(groups.select("lang", "source", "sid", "total", "kept", "lang_total", "zero"), ["lang", "source"])
    rated = rated.select("lang", "source", "term", "sid", "zero", rate("n", "total", "kept").alias("p"), rate("lang_n", "lang_total", "kept").alias("q"))
    pairs = pair_values(rated, groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [
        pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value").withColumn("rank", F.row_number().over(order)),
        rated.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top),
    ]
    out = materialize(ranked[0].unionByName(ranked[1]), "divergence")
    release(kept, groups)
    return out
