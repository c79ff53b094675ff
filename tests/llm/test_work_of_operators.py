"""How much work some operators do: nothing is worked out twice that is at hand."""

from __future__ import annotations

import numpy as np
import pytest


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- token counts


def test_learned_chunks_are_not_worked_out_again(vocabulary, monkeypatch):
    """More chunks than the table remembers: each is still worked out once a group of texts."""
    from tokenizers import Tokenizer

    from meterlake.llm.token_counts import PrefixTable
    from meterlake.llm.words import Recent

    monkeypatch.setattr(Recent, "LIMIT", 3)
    table = PrefixTable(vocabulary)
    asked = []
    table.chunks.compute = lambda chunk: asked.append(chunk) or table._chunk(chunk)
    texts = ["señora thing Thing, weiß, weiße %%% x'y", "thing señor\tthing\nñ日本語ing, Thing, weiß,", "", "one two three four five six seven thing"]
    known = table.learn([t.encode() for t in texts])
    count = Tokenizer.from_file(vocabulary)
    for t in texts:
        got = np.cumsum(np.frombuffer(table.deltas(t.encode(), known), dtype=np.int8)).tolist()
        assert got == [len(count.encode(t[:i], add_special_tokens=False).ids) for i in range(1, len(t) + 1)]
    assert sorted(asked) == sorted({c for t in texts for c in t.split()} | {""})


# ---------------------------------------------------------------- similarity


def test_a_bitmap_takes_few_jobs_at_any_number_of_partitions(spark):
    from meterlake.llm.shared import Bitmap

    df = spark.range(5000).selectExpr("xxhash64(id) AS key")
    keys = np.array([r.key for r in df.collect()], np.int64)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        spark.sparkContext.setJobGroup("bitmap", "bitmap")
        bits = Bitmap.of(df, "key", 5000)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("bitmap"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert jobs <= 5 and bits.has(keys.view(np.uint64)).all()
    assert bits.has((keys ^ 0x5555).view(np.uint64)).mean() < 0.2


def similar_groups(groups, each, common=""):
    """Groups of texts, each like the first of its group but for its last word, and the group of each."""
    texts = [(100 * g + i, " ".join([f"g{g}w{k}" for k in range(60)] + common.split() + [f"end{i}"]), g) for g in range(groups) for i in range(each)]
    return [t[:2] for t in texts], {t[0]: 100 * t[2] for t in texts}


@pytest.mark.parametrize("few, calls", [(8, 2), (-1, 3)])
def test_star_rounds_are_left_out_where_few_pairs_are_open(spark, monkeypatch, few, calls):
    from meterlake.llm import ngram_join

    real, done = ngram_join.verified, []
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "verified", lambda *a: done.append(1) or real(*a))
    # each half of a text is that of another group: few grams are in several components
    rows, want = similar_groups(6, 3)
    rows += [(1000 + g, " ".join([f"g{g}w{k}" for k in range(12)] + [f"o{g}w{k}" for k in range(2)]), ) for g in range(6)]
    out = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == want | {1000 + g: 1000 + g for g in range(6)}
    assert len(done) <= calls


def test_rows_near_the_middle_of_a_group_of_copies_take_in_the_others(spark, monkeypatch):
    """Copies with three or four changed words are similar to few but the text itself: they must not all meet one another."""
    import random

    from meterlake.llm import ngram_join

    rng, real, met = random.Random(4), ngram_join.verified, []
    monkeypatch.setattr(ngram_join, "verified", lambda pairs, *a: met.append(pairs.distinct().count()) or real(pairs, *a))
    rows = []
    for i in range(200):
        words = [f"w{k}" for k in range(200)]
        for k in rng.sample(range(10, 190), 0 if i == 77 else rng.choice([3, 4])):
            words[k] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}
    assert sum(met) <= 16 * len(rows)


@pytest.mark.parametrize("changed", [0, 1])
def test_no_pair_left_gives_the_same_components(spark, changed):
    from meterlake.llm.ngram_join import jaccard_components

    rows = [(1, "a b c d e f g"), (2, "a b c d e f g" if not changed else "h i j k l m n"), (3, ""), (4, None)]
    got = {r.doc_id: r.component_id for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1 + changed, 3: 3, 4: 4}


# ---------------------------------------------------------------- quality


def test_the_quality_model_remembers_few_words():
    """Texts of ever new words: a worker's tables stay small, and features are the same as without them."""
    from meterlake.llm import quality_model

    quality_model._WORD.forget(), quality_model._SHAPE.forget()
    texts = [" ".join(f"Word{k}x{'yz' * (k % 5)}" for k in range(i, i + 20_000)).encode() for i in range(0, 160_000, 20_000)]
    first = [quality_model.features(t) for t in texts]
    held = sum(len(t) + len(t.old) for t in (quality_model._WORD, quality_model._SHAPE))
    assert held <= 4 * quality_model.REMEMBERED and held <= 200_000
    again = [quality_model.features(t) for t in texts]
    assert all((a == b).all() for x, y in zip(first, again) for a, b in zip(x, y))
    quality_model._WORD.forget(), quality_model._SHAPE.forget()


def test_the_quality_model_works_out_a_shape_once(monkeypatch):
    """New words of known shapes need no look at their shape, and features are those of words taken one by one."""
    import re

    import xxhash

    from meterlake.llm import quality_model as Q
    from meterlake.llm.words import mix

    def plain(text, bits=Q.BITS):
        words = text.split()
        one = lambda b: ord("a") if 97 <= b < 123 or b > 127 else ord("A") if 65 <= b < 91 else ord("0") if 48 <= b < 58 else b
        shape = lambda w: re.sub(rb"(.)\1+", rb"\1", bytes(map(one, w)), flags=re.DOTALL)
        own, forms = (np.array([xxhash.xxh3_64_intdigest(f(w)) for w in words], np.uint64) for f in (bytes.lower, shape))
        shift = np.uint64(64 - bits)
        pairs = mix(own[:-1] * np.uint64(3) + own[1:])
        grams = np.unique(mix(np.concatenate([own, pairs + np.uint64(1)])) >> shift)
        steps = mix(forms[:-1] * np.uint64(5) + forms[1:])
        same = np.full(int((own[1:] == own[:-1]).sum()), np.uint64(2**64 - 1))
        looks, counts = np.unique(mix(np.concatenate([forms, steps, same]) + np.uint64(2)) >> shift, return_counts=True)
        values = np.concatenate([np.full(len(grams), len(grams) ** -0.5), counts / len(words)])
        return np.concatenate([grams, looks]).astype(np.int64), values

    Q._WORD.forget(), Q._SHAPE.forget()
    odd = ["  Then, THEN then\n\n\t ñÑ日本 aa\x0b\x0cBB11--22__!! x\r\n", "a", "A\x00\x00b\x1cc\x85d\u3000e\xa0f  ", "...,,, 12 1234 Zz\n"]
    for text in odd:
        assert all((a == b).all() for a, b in zip(Q.features(text.encode()), plain(text.encode())))
    assert not len(Q.features(b"")[0]) and not len(Q.features(b" \n\t ")[0])
    asked = []
    monkeypatch.setattr(Q._SHAPE, "compute", lambda w: asked.append(w) or xxhash.xxh3_64_intdigest(w))
    text = " ".join(f"Word{k}x" for k in range(5000)).encode()
    assert all((a == b).all() for a, b in zip(Q.features(text), plain(text)))
    assert asked == [b"Aa0a"]
    Q._WORD.forget(), Q._SHAPE.forget()


# ---------------------------------------------------------------- language model


def test_pairs_of_common_words_travel_without_their_counts():
    """A pair of small numbers tells its words, whose counts the tasks have: only pairs with other words take counts along."""
    import pyarrow as pa

    from meterlake.llm import lm_score as M
    from meterlake.llm.shared import Bitmap

    by_token = np.zeros(M.SIDE, np.int64)
    by_token[:2], by_token[M.END] = (6, 4), 2
    other = np.array([M.word_id(b"c")])
    words = M.Words({b"a": 0, b"b": 1}, by_token, by_token * 0, other, np.array([3]), 2, 0, 4, 15, 0)
    weights = np.tile([0.4, 0.5, 0.1], (M.BUCKETS, 1))
    none = np.empty(0, np.int64)
    model = M.Model(words, weights, words.contexts(), none, none)
    full = Bitmap(np.full(2**13, 255, np.uint8), 16)
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(["a b a b c", "b a"]), pa.array([True, False])], ["doc_id", "text", "learned"])
    [out] = M.score_batches(iter([batch]), model, full, full)
    rows = out.to_pylist()
    small = lambda *pairs: [c * M.SIDE + t for c, t in pairs]
    assert rows[0]["small_pairs"] == small((M.START, 0), (0, 1), (1, 0), (0, 1)) and rows[1]["small_pairs"] == small((M.START, 1), (1, 0), (0, M.END))
    assert [rows[0][c] for c in ("context_n", "token_n")] == [[4, 3], [3, 2]] and not rows[1]["pairs"]
    values = {f.name: sum(len(v) for v in out.column(f.name).to_pylist()) for f in out.schema if pa.types.is_list(f.type)}
    assert values == {"small_pairs": 7, "pairs": 2, "context_n": 2, "token_n": 2} | {c: 0 for c in values if c not in ("small_pairs", "pairs", "context_n", "token_n")}


def test_pairs_whose_count_is_at_hand_do_not_ask_for_it():
    """Pairs of a rare word that occur once, in the text itself, ask for the count of the word alone."""
    import pyarrow as pa

    from meterlake.llm import lm_score as M
    from meterlake.llm.shared import Bitmap

    by_token = np.zeros(M.SIDE, np.int64)
    by_token[0], by_token[M.END] = 6, 2
    none = np.empty(0, np.int64)
    words = M.Words({b"a": 0}, by_token, by_token * 0, none, none, 2, 0, 3, 10, 0)
    model = M.Model(words, np.tile([0.4, 0.5, 0.1], (M.BUCKETS, 1)), words.contexts(), none, none)
    full, empty = (Bitmap(np.full(2**13, fill, np.uint8), 16) for fill in (255, 0))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(["a c", "a c"]), pa.array([True, False])], ["doc_id", "text", "learned"])
    c = M.word_id(b"c")
    asked = M.pair_id(np.array([0, c]), np.array([c, M.END])).tolist()
    for pair_bits, learned in ((empty, [0, 0]), (full, asked)):
        [out] = M.score_batches(iter([batch]), model, pair_bits, full)
        one, two = out.to_pylist()
        assert one["far_pairs"] == learned and one["far_n"] == [1, 1] and one["words"] == two["words"] == [c]
        assert two["far_pairs"] == asked and two["far_n"] == [0, 0] and one["token"] == two["token"] == [c, 0]
