"""URL filters, token alignment and the source audit against brute force and SQL on small tables."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string"


def duck(tmp_path, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        path = f"{tmp_path}/{name}.parquet"
        df.write.parquet(path)
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    return con


def same(got, want):
    as_text = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert as_text(got) == as_text(want)


# ---------------------------------------------------------------- urls


PAGES = [
    (1, "http://A.example.org/en/2?x=1#top", ""),
    (2, "https://a.example.org/en/2?x=1", '<link rel="canonical" href="/es/9">'),
    (3, "http://x.example.com/de/1", "<p>"),
    (4, "http://x.example.com/en/1", "<LINK href='http://x.example.com/de/1' REL=canonical>"),
    (5, "http://mirror.net/en/1", '<meta http-equiv="refresh" content="0; url=//x.example.com/en/1">'),
    (6, "http://other.net/a/b?q", '<link rel="canonical" href="c?d=1&amp;e=2"><link rel=canonical href=ignored>'),
    (7, "http://other.net/a/c?d=1&e=2", '<link rel="stylesheet" href="http://x.example.com/de/1">'),
    (8, "http://both.net/1", '<link rel="canonical" href="http://shop.com/fr/1">'),
    (9, "http://both.net/1#2", '<meta http-equiv=refresh content="5;URL=\'http://shop.com/de/1\'">'),
    (10, "http://both.net", ""),
    (11, "http://plain.org", ""),
    (12, "http://plain.org/", ""),
    (13, None, None),
    (14, "no address", '<link rel="canonical" href="http://x.example.com/de/1">'),
    (15, "://example.org/en/1", None),
    (16, "http://com/de/", ""),
    (17, "http://notexample.org/es/1", ""),
    (18, "http://sub.example.org?x/es/", ""),
    (None, "http://x.example.com/de/1", ""),
    (3, "http://x.example.com/de/1", "<p>"),
    (19, "", ""),
    (20, "http:///path", "<link rel=canonical href=x>"),
    (21, "http://far.net/?q", '<link rel="canonical" href="?z">'),
    (22, "http://far.net/?z", '<link rel="canonical" href="http://www.example.org/en/1234">'),
]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    names = "host path query node rule says verdict a b root allows link from_url to_url end rest".split()
    return df.repartition(4).select("*", *[F.lit(n).alias(n) for n in names])


def test_url_verdicts_equal_the_sql_and_follow_aliases(spark, pages, tmp_path):
    from meterlake.llm import registry, url_filters

    con = duck(tmp_path, pages=pages)
    got = registry.op11_url_filters(spark, str(tmp_path))
    want = con.execute(registry.ORACLE_SQL["op11_url_filters"])
    assert sorted(got.columns) == sorted(d[0] for d in want.description)
    same(got.select("page_id", "host", "path", "rule", "verdict").collect(), want.fetchall())
    judged = {r.page_id: r for r in url_filters.judge_urls(pages, registry.URL_RULES).collect()}
    # a mirror of an alias of a blocked address; relative links; an allow beside a block among the aliases
    assert [judged[i].verdict for i in (2, 3, 4, 5, 6, 7)] == ["allow", "block", "block", "block", "allow", "allow"]
    assert [judged[i].by_alias for i in (3, 4, 5, 6)] == [False, True, True, False]
    assert judged[8].verdict == "allow" and judged[8].by_alias
    assert judged[11].verdict == "allow" and judged[11].rule is None and judged[12].rule == "org/"
    assert judged[22].verdict == judged[21].verdict == "block"
    assert judged[13].host == judged[13].path == "" and judged[13].verdict == "allow"


def test_url_rules_of_any_size_and_logged_redirects(spark):
    from meterlake.llm.url_filters import judge_urls

    rng = random.Random(3)
    hosts = ["a.net", "b.a.net", "c.b.a.net", "d.org", "e.d.org"]
    paths = ["/", "/x", "/x/y", "/xy", "/x/y/z", ""]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}?{i}" for i in range(300)]
    rules = {(rng.choice(hosts), p): rng.choice(["allow", "block"]) for p in ("/x", "/x/y", "/xy", "/nowhere") for _ in range(2)}
    redirects = [(rng.choice(urls), rng.choice(urls)) for _ in range(90)] + [(u, urls[0]) for u in urls[:60]] + [(None, urls[1]), (urls[2], "nowhere")]

    def says(url):
        host, path = re.match(r"http://([^/?]*)([^?]*)", url).groups()
        fits = [(len(h + p), len(h), v == "allow", h + p) for (h, p), v in rules.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, default=None)

    nodes = {u: u.replace("net?", "net/?").replace("org?", "org/?") for u in urls}
    group = {n: {n} for n in nodes.values()}
    for a, b in redirects:
        if a in nodes and b in nodes:
            joined = group[nodes[a]] | group[nodes[b]]
            for n in joined:
                group[n] = joined
    own = collections.defaultdict(set)
    for u in urls:
        if says(u):
            own[nodes[u]].add(says(u)[2])
    want = []
    for i, u in enumerate(urls):
        near = set().union(*[own[n] for n in group[nodes[u]]])
        rule = says(u)
        allowed = rule[2] if rule else (True in near or not near)
        want.append((i, rule[3] if rule else None, "allow" if allowed else "block"))
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame([(v, h, p) for (h, p), v in rules.items()], "verdict string, host string, path string")
    logged = spark.createDataFrame(redirects, "from_url string, to_url string")
    got = judge_urls(pages, table, logged, html_col=None).select("page_id", "rule", "verdict")
    assert {v for _, _, v in want} == {"allow", "block"}
    same(got.collect(), want)
    assert judge_urls(pages.limit(0), table, logged, html_col=None).count() == 0
    no_rules = judge_urls(pages, table.limit(0), html_col=None)
    assert [r.verdict for r in no_rules.select("verdict").distinct().collect()] == ["allow"]


def test_url_plan_has_no_python(pages):
    from meterlake.llm.registry import URL_RULES
    from meterlake.llm.url_filters import _edges, fitting_rule, judge_urls, page_links, rules_of

    links = page_links(pages)
    forms = pages.select("host", "path")
    for df in (judge_urls(pages, URL_RULES), _edges(links), fitting_rule(forms, rules_of(pages.sparkSession, URL_RULES))):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# ---------------------------------------------------------------- alignment


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    return paths, a, sentencepiece.SentencePieceProcessor(model_file=paths[1])


def plain_alignment(text, a, b):
    """(n_a, n_b, groups, links) by the definition, quadratic in the tokens; None without tokens."""
    from meterlake.llm.token_alignment import byte_letters

    if not text:
        return None
    letters, whole = byte_letters(), (" " + text).encode()
    ids = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(letters[c] for c in t)) for i, t in zip(ids.ids, ids.tokens)]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    spans = []
    for side in (left, right):
        at, out = 0, []
        for i, part in side:
            out.append((i, at, at + len(part)))
            at += len(part)
        if b"".join(p for _, p in side) != whole:
            return None
        spans.append(out)
    links = [(i, j) for i, lo, hi in spans[0] for j, low, high in spans[1] if lo < high and low < hi]
    groups, start = [], 0
    for end in sorted({h for *_, h in spans[0]} & {h for *_, h in spans[1]}):
        groups.append("|".join(",".join(str(i) for i, lo, hi in side if start <= lo and hi <= end) for side in spans))
        start = end
    return len(left), len(right), groups, links


TEXTS = [
    "The quick brown fox", "été über 中文字 🙂🙃", "  two  spaces\n\n\ttab ", "<s>special</s> <|endoftext|> <unk> <0x41>", "▁low line ▁", "x" * 300,
    "a b​c", "internationalization unbelievable", "don't we'll 123456 3.14", None, "", " ", "\n", "\x00 nul", "ﬁ ﬀ ² Å Å", "The quick brown fox",
]


def test_alignment_equals_the_definition(spark, tokenizers):
    from meterlake.llm.token_alignment import align_documents

    paths, a, b = tokenizers
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice(["the ", "ing", "é", "中", " ", "\n", "Qu", "🙂", "12", "'s", "_"]) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    texts += ["hot text"] * 80 + ["long words and numbers 123 " * 3000]
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)] + [(5, texts[5]), (5, "another text of the id")]
    short = {t: plain_alignment(t, a, b) for t in {t for _, t in rows} if t is None or len(t) < 5000}
    long = texts[-1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    docs = docs.select("*", *[F.lit(1).alias(n) for n in "key copies pair docs best n_a links rest x".split()])
    outs = [align_documents(docs, *paths, most_cached=n).collect() for n in (1 << 20, 40, 0)]
    same(outs[0], outs[1])
    same(outs[0], outs[2])
    counts = collections.Counter()
    for _, t in rows:
        if t != long and short[t]:
            counts.update(set(short[t][3]))
    ids = a.encode(" " + long, add_special_tokens=False).ids
    got_long = [r for r in outs[0] if r.n_a > 5000]
    assert len(got_long) == 1 and got_long[0].n_a == len(ids) and got_long[0].n_b == len(b.encode(long))
    # the long text repeats one line, so the pairs of a short form of it are its pairs
    counts.update(set(plain_alignment(long[:81], a, b)[3]))
    highest = collections.Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    want = []
    for i, t in rows:
        if t == long:
            continue
        if short[t] is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = short[t]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        want.append((i, n_a, n_b, len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), digest))
    fields = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    same([tuple(r[f] for f in fields) for r in outs[0] if r.n_a <= 5000], want)
    assert sum(w[1] == 0 for w in want) == 3


def test_ranks_give_the_ids_of_the_library(tokenizers):
    from meterlake.llm.token_alignment import Aligner

    paths, a, _ = tokenizers
    tool = Aligner(*paths)
    assert tool.ranks
    ids = lambda t: a.encode(t, add_special_tokens=False).ids
    rng = random.Random(1)
    parts = [" ", " ", "  ", "\n", "\t", "word", "Word", "don't", "'s", "'S", "123", "é", "中文", "🙂", "!", "...", ";\r", "\x85", "\u3000", "\xa0",
             "\x1c", "\u200b", "\ufeff", "▁", "_", "<|endoftext|>", "\x00", "internationalization", "ﬁ", "\u180e", "\v", "²", "Ⅷ", "a" * 50]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert tool.ids_a(text) == ids(text), repr(text)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 64):  # every code point beside letters, digits, signs and blanks
        text = "".join(f"x{c}1{c}!{c} {c}{c}" for c in points[i : i + 64])
        assert tool.ids_a(text) == ids(text), (hex(i), repr(points[i]))
    tool.ranks = None
    assert tool.ids_a("a text") == ids("a text")


def test_alignment_of_an_empty_table(spark, tokenizers):
    from meterlake.llm.token_alignment import align_documents

    assert align_documents(spark.createDataFrame([], "doc_id long, text string"), *tokenizers[0]).collect() == []


# ---------------------------------------------------------------- sources


def plain_audit(rows, least, top):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for *_, terms in own for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= least)
        groups = sorted({s for _, s, _ in own})
        count = {g: collections.Counter(t for _, s, terms in own if g in (None, s) for t in terms if seen[t] >= least) for g in [None, *groups]}
        rate = {g: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for g, c in count.items()}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for g in groups:
            parts = {
                "pair": [(o, sum(f(rate[g][t], rate[o][t]) for t in kept)) for o in groups if o != g],
                "term": [(t, f(rate[g][t], rate[None][t])) for t in kept if count[g][t] and rate[g][t] > rate[None][t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, g, part, item, value, i + 1) for i, (item, value) in enumerate(items) if part == "pair" or i < top]
    return out


@pytest.fixture(scope="module")
def sourced_rows():
    rng = random.Random(11)
    words = "alpha Beta γάμα Δέλτα epsilon's zeta-eta THETA iota kappa λ mu nu xi ÖL ölig été 中文 a b c".split()
    rows = []
    for i in range(160):
        n = rng.randint(0, 40)
        source = rng.choice(["s0"] * 5 + ["s1", "s2", "s3", "é", None, ""])
        lang = rng.choice(["en", "en", "de", None])
        bias = words[: rng.choice([4, 9, len(words)])]
        rows.append((i, " ".join(rng.choice(bias) for _ in range(n)), lang, source))
    rows += [(200, None, "en", "s9"), (201, "", "xx", "only"), (202, "alpha 1 2 3", "xx", "other"), (None, None, None, None), (203, "9 _ [ `", "en", "signs")]
    rows += [(7, rows[7][1], rows[7][2], rows[7][3])] * 30 + [(8, rows[7][1], rows[7][2], "copycat")] * 5
    rows.append((300, "rare1 alpha " * 4000, "de", "s1"))
    return rows


def test_source_audit_equals_brute_force(spark, sourced_rows):
    from meterlake.llm import source_divergence

    docs = spark.createDataFrame(sourced_rows, DOCS).repartition(7)
    docs = docs.select("*", *[F.lit(1).alias(n) for n in "h sources copies term n first sid zero kept value rank item".split()])
    for least, top in ((10, 10), (3, 2)):
        got = source_divergence.audit_sources(docs, least, top).collect()
        same(got, plain_audit(sourced_rows, least, top))


@pytest.mark.parametrize("held", [1, 700, 10**9])
def test_tasks_hand_on_what_they_hold_at_any_limit(sourced_rows, monkeypatch, held):
    import pyarrow as pa

    from meterlake.llm import source_divergence as audit

    for name in ("HELD_BYTES", "HELD_TERMS", "HELD_PAIRS"):
        monkeypatch.setattr(audit, name, held)
    rows = [(lang or "", source or "", text) for _, text, lang, source in sourced_rows if text]
    rows = [(*r, hash(r[2]) % 5) for r in rows]  # different texts share a hash
    names = ["lang", "source", "text", "h"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i : i + 9]]) for i in range(0, len(rows), 9)]
    met = pa.Table.from_batches(list(audit._collapse(iter(batches)))).to_pylist()
    assert sum(sum(r["copies"]) for r in met) == len(rows)
    met.sort(key=lambda r: (r["lang"], r["h"]))
    parts = [pa.RecordBatch.from_pylist(met[i : i + 4]) for i in range(0, len(met), 4)]
    n, docs = collections.Counter(), collections.Counter()
    for batch in audit._count_terms(iter(parts)):
        for r in batch.to_pylist():
            n[r["lang"], r["source"], r["term"]] += r["n"]
            docs[r["lang"], r["source"], r["term"]] += r["docs"]
    want, want_docs = collections.Counter(), collections.Counter()
    for lang, source, text, _ in rows:
        terms = [t.decode() for t in audit.terms_of(text.encode())]
        want.update((lang, source, t) for t in terms)
        want_docs.update({(lang, source, t) for t in terms})
    assert n == want and docs == want_docs


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_terms_that_go_on_in_the_next_batch_meet_their_pairs(size):
    import pyarrow as pa

    from meterlake.llm.source_divergence import _meet

    rng = random.Random(size)
    rows, want = [], collections.Counter()
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in ("de", "en"):
        zero = [rng.randint(1, 10**6) for _ in range(9)]
        for term in "abcdefg":
            p = {s: rng.randint(1, 10**9) for s in rng.sample(range(9), rng.randint(1, 9))}
            rows += [dict(lang=lang, term=term, sid=s, p=p[s], zero=zero[s]) for s in p]
            for s in p:
                for t in p:
                    if s < t:
                        want[lang, s, t] += f(p[s], p[t]) - f(p[s], zero[t]) - f(zero[s], p[t]) + f(zero[s], zero[t])
    batches = [pa.RecordBatch.from_pylist(rows[i : i + size]) for i in range(0, len(rows), size)]
    got = collections.Counter()
    for batch in _meet(iter(batches)):
        for r in batch.to_pylist():
            got[r["lang"], r["s"], r["t"]] += r["value"]
    assert got == want


def test_source_audit_equals_the_sql(spark, sourced_rows, tmp_path):
    from meterlake.llm import registry

    con = duck(tmp_path, documents=spark.createDataFrame(sourced_rows, DOCS))
    got = registry.op13_source_divergence(spark, str(tmp_path))
    same(got.collect(), con.execute(registry.ORACLE_SQL["op13_source_divergence"]).fetchall())


def test_source_audit_of_empty_tables_and_many_sources(spark):
    from meterlake.llm.source_divergence import audit_sources

    assert audit_sources(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(i, f"one two {'three ' * (i % 5)}", "en", f"s{i % 60}") for i in range(240)]
    same(audit_sources(spark.createDataFrame(rows, DOCS)).collect(), plain_audit(rows, 10, 10))


def test_terms_are_split_like_the_pattern():
    from meterlake.llm.source_divergence import terms_of

    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice("aZ09 \n\t_[`{~@é中\x85  İ🙂") for _ in range(30))
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        assert [t.decode() for t in terms_of(text.encode())] == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
