"""The ten operators on small inputs: against brute force, and on nulls, empty and long texts, repeated rows and empty tables."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from brute import components, fingerprint, lowered, without_repeats, words
from pyspark.sql import functions as F

import corpus_pipeline
from tracelake.llm import decontam, htmltext, jaccard, mixing, packing, quality, queries, rules, simhash, substring, toxicity, urlfilter
from tracelake.llm.common import training_rows
from tracelake.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h int, row int, anchor string"


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, empty and null texts, null and repeated ids, one very long text."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, out = text(60), []
    for i in range(60):
        out.append((i, text(rng.randint(1, 150)) + ("\n" + passage if i % 7 == 0 else "")))
    base = text(200)
    out += [(100 + i, base) for i in range(4)] + [(110, base.upper()), (111, base + " z"), (112, "a " * 90)]
    out += [(120, None), (121, ""), (122, " \n\t"), (123, "one"), (124, "One"), (125, text(9000)), (None, text(50)), (None, base), (3, out[3][1])]
    return [(i, t, "en" if (i or 0) % 3 else None, f"src{(i or 0) % 4}", len(t or ""), 1, 2, "x") for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring(docs, rows, empty):
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.without_repeats(docs).collect()), key=str)
    assert got == sorted(((r[0], *x) for r, x in zip(rows, without_repeats([r[1] for r in rows]))), key=str)
    assert substring.digest(substring.without_repeats(empty)).collect() == []


def test_substring_with_hot_keys(docs, rows, monkeypatch, spark):
    many = spark.createDataFrame([(i, f"{i} a b {i % 3} " + rows[0][1]) for i in range(200)], "doc_id long, text string").repartition(70)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.without_repeats(many).collect()}
    data = sorted((r.doc_id, r.text) for r in many.collect())
    assert got == {i: x for (i, _), x in zip(data, without_repeats([t for _, t in data]))}


def test_simhash(docs, rows, empty):
    marks = [fingerprint(r[1]) for r in rows]
    want = sorted(zip((r[0] for r in rows), marks, components([r[0] for r in rows], marks)), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str) == want
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len({c for *_, c in want if c is not None}) + len({m for i, m, c in want if c is None})
    assert simhash.near_duplicates(empty).count() == 0


def test_anchors_lose_no_pair():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 300)
    b = a.copy()
    for i in range(300):
        for bit in rng.choice(62, i % 3, replace=False):
            b[i] ^= 1 << int(bit)
    _, home = simhash.anchors(a, 0)
    row, guest = simhash.anchors(b, 2)
    assert len(home) == 300 and all(home[i] in guest[row == i] for i in range(300))


def _jaccard_roots(texts):
    """For each text, the least index that it reaches by links of five-word Jaccard similarity 0.8 or more, by brute force."""
    sets, root = [], list(range(len(texts)))
    for t in texts:
        w = words(lowered(t))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    holders = {}
    for i, s in enumerate(sets):
        for x in s or [()]:
            holders.setdefault(x, []).append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s or [()] for j in holders[x] if j < i}:
            if 5 * len(s & sets[j]) >= 4 * len(s | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_jaccard_finds_every_pair(spark, docs, empty):
    rng = random.Random(5)
    base = [rng.choices([f"w{i}" for i in range(400)], k=rng.randint(40, 160)) for _ in range(30)]
    near = []
    for b in base:
        for _ in range(6):
            c = list(b)
            for _ in range(rng.randint(0, max(1, len(b) // 50))):
                c[rng.randrange(len(c))] = "changed" + str(rng.random())
            near.append(c + ["the", "same", "closing", "line", "everywhere", "again"])
    table = [(i, " ".join(w)) for i, w in enumerate(near)] + [(1000, None), (1001, " "), (1002, "one two"), (1003, "One  two")]
    table += [(2000 + r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    roots = _jaccard_roots([t for _, t in table])
    want = {i: table[r][0] for (i, _), r in zip(table, roots)}
    got = jaccard.components(spark.createDataFrame(table, "doc_id long, text string").repartition(7)).collect()
    least = {}
    for r in got:
        least[r.root] = min(r.doc_id, least.get(r.root, r.doc_id))
    assert {r.doc_id: least[r.root] for r in got} == want and len(set(roots)) < len({t for _, t in table})
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.near_duplicate_stage(spark, full, "")
    assert kept.columns == corpus_pipeline.COLUMNS and kept.count() == len(set(_jaccard_roots([r.text for r in full.collect()])))
    few = jaccard.keep_one_of_each(docs)
    assert few.columns == docs.columns and few.count() == len(set(_jaccard_roots([r.text for r in docs.collect()])))
    assert jaccard.keep_one_of_each(empty).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 50 + i) for i in range(30)] + [(7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[50 + i] == 50 for i in range(30)) and got[100] == 50


def test_decontamination(spark, docs, rows, empty):
    items = [(1, " ".join((rows[5][1] or "").split()[:30])), (2, "not there at all in any text"), (3, "one"), (4, None), (5, ""), (1, "another text of id one here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def shingles(t):
        w = words(lowered(t))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    want = set()
    for i, t, *_ in rows:
        for j, u in items:
            s = shingles(u)
            if s and len(shingles(t) & s) >= 0.8 * len(s):
                want.add((i, j, len(s), len(shingles(t) & s)))
    assert {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in decontam.leaks(docs, benchmark).collect()} == want and want
    assert decontam.keep_clean(docs, benchmark).count() == sum(r[0] not in {w[0] for w in want} for r in rows)
    assert decontam.leaks(empty, benchmark).count() == 0 and decontam.leaks(docs, benchmark.limit(0)).count() == 0


def test_decontamination_of_a_dump_of_items(spark):
    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(50))) for i in range(1000)]
    docs = spark.createDataFrame([(1, " ".join(t for _, t in items)), (1, items[0][1]), (None, items[1][1]), (2, "clean words of a text")], "doc_id long, text string")
    got = decontam.leaks(docs, spark.createDataFrame([*items, (None, items[2][1])], "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted([(1, i) for i, _ in items] + [(1, None), (None, 1)], key=str) and {r.n_shared for r in got} == {46}


@pytest.mark.parametrize("model, label, recall, precision", [(quality, "quality", 0.98, 0.98), (toxicity, "toxic", 0.75, 0.65)])
def test_classifiers(spark, docs, empty, model, label, recall, precision):
    all_docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fitted = model.fit(all_docs, labels)
    got = model.score(all_docs, fitted).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    caught, positive, said = (sum(map(f, held)) for f in (lambda r: r.predicted * r[label], lambda r: r[label], lambda r: r.predicted))
    assert caught >= recall * positive and caught >= precision * said
    ones, zeros = ([r.score for r in held if r[label] == y] for y in (1, 0))
    assert sum((a > b) + (a == b) / 2 for a in ones for b in zeros) >= 0.9 * len(ones) * len(zeros)
    edge = model.score(docs, fitted)
    assert edge.count() == docs.count() and edge.where("score is null or score < 0 or score > 1").count() == 0
    assert model.score(empty, fitted).count() == 0


@pytest.mark.parametrize("model, label", [(quality, "quality"), (toxicity, "toxic")])
def test_without_both_labels_all_texts_score_the_same(spark, docs, empty, model, label):
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    n = len({r.doc_id for r in ids.collect() if zlib.crc32(str(r.doc_id).encode()) % 5})
    for labels, share in ((ids.limit(0).withColumn(label, F.lit(1)), 0.5), (ids.withColumn(label, F.lit(0)), 1 / (n + 2)), (ids.withColumn(label, F.lit(1)), (n + 1) / (n + 2))):
        scored = model.score(docs, model.fit(docs, labels)).collect()
        assert {round(r.score, 6) for r in scored} == {round(share, 6)} and len(scored) == docs.count()
        assert label == "quality" or not any(r.offending for r in scored)


def test_quality_of_a_text_is_its_own(spark):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    model = quality.Model(rng.normal(size=1 << quality.LOG_BUCKETS).astype(np.float32), 0.1, 0.25)
    texts = ["", "abc def", "x", None, "", "\n", "ab", " a longer one, with é and\nlines ", "", "end"]
    alone = [model.scores(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(model.scores(pa.array(texts)), alone, rtol=0, atol=1e-9)
    assert alone[0] == alone[3] == alone[5] == 0.25


def test_training_takes_one_row_of_each_id(spark):
    texts = [(1, f"text {i}") for i in range(50)] + [(2, "other"), (2, "another"), (3, None), (4, "fourth")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, quality int")
    found = [training_rows(spark.createDataFrame(t, "doc_id long, text string").repartition(6), labels, "quality", 4).collect() for t in (texts, texts[::-1])]
    want = {i for i in range(1, 5) if zlib.crc32(str(i).encode()) % 5}
    assert len(found[0]) == len(want) > 1 and sorted(map(str, found[0])) == sorted(map(str, found[1]))


def test_toxicity_points_at_sentences(spark):
    import pyarrow as pa

    texts = [(f"good words here number{i}. quite fine day", 0) for i in range(200)] + [(f"good words here. vilest insult number{i}. fine day", 1) for i in range(60)]
    long = "calm words follow one another. " * 2500
    texts += [(long + "vilest insult once. " + long, 1), (long + long, 0)]  # all of a text is learnt from
    sample = toxicity.sample_of(spark.createDataFrame([(t, y, i) for i, (t, y) in enumerate(texts)], "text string, y int, hash long"))
    middle = next(t for t in sample.texts if t[0] and t[3] == 5001)
    assert set(middle[2]) == {2500} and all(n == 5000 and not len(ids) for y, ids, _, n in sample.texts if n > 100 and not y)
    model = toxicity.train(sample)
    p, row, begins = model.sentences(pa.array(["all good words. vilest insult again. fine day"]))
    assert p.argmax() == 1 and begins[1] == 16 and p[1] > 0.5
    assert [x > 0.5 for x in model.scores(pa.array([t for t, _ in texts[-2:]]))] == [True, False]


def test_quality_learns_from_whole_texts():
    import pyarrow as pa

    text, column = "ab cd ab " * 5000, lambda x: pa.array([x], pa.string())
    (got,) = quality._training_features([pa.RecordBatch.from_pydict({"text": [text], "y": pa.array([1], pa.int32()), "hash": [5]})])
    ids, shares = (np.frombuffer(got.column(c)[0].as_py(), k) for c, k in (("ids", np.int32), ("shares", np.float32)))
    found = np.concatenate([ids for ids, _ in quality.features(column(text))])
    assert len(found) > 100_000 and np.allclose(shares, np.bincount(found)[ids] / len(found)) and set(ids) == set(found)


def test_rules(docs, rows, spark, empty):
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules.judged(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        w, seen, dup = words(t), set(), 0
        for line in (t or "").split("\n"):
            if words(line):
                dup, seen = dup + (line in seen), seen | {line}
        grams = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        covered = {j + k for j, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(w) < 1000 else None
        if covered is None:
            from collections import Counter

            counts = Counter(grams)
            covered = {j + k for j, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
        want.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    assert got == sorted(want, key=str)
    assert rules.judged(empty, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


@pytest.mark.parametrize("limit, sf", [(rules.LIMIT, "0.01"), (0.2, "0.01"), (rules.LIMIT, "0.1")])
def test_rules_match_sql(spark, limit, sf):
    """At sf0.01 too few texts are labelled for the smaller strata; at sf0.1 the registered limit rejects texts in every one."""
    db = duckdb.connect()
    docs, labels = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("documents", "labels"))
    for t in ("documents", "labels"):
        db.execute(f"create view {t} as select * from '/root/testdata/sf{sf}/{t}.parquet'")
    want = db.execute(queries.rules_sql(limit))
    columns = [d[0] for d in want.description]
    rows = rules.judged(docs, labels, limit=limit).withColumn("rejected_by", F.array_join("rejected_by", ","))
    assert columns == rows.columns
    got = sorted(map(tuple, rows.collect()))
    assert got == sorted(want.fetchall())
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rejecting = {lang[r[0]] for r in got if not r[6] and r[-1]}
    assert "en" in rejecting and (sf == "0.01" or len(rejecting) == 4)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    passed = {q: [not r[-1] for r in got if not r[6] and quality.get(r[0]) == q] for q in (0, 1)}
    assert limit > rules.LIMIT or (sum(passed[1]) >= 0.98 * len(passed[1]) and (sf == "0.01" or sum(passed[0]) < 0.5 * len(passed[0])))


def test_rules_keep_the_limit(spark):
    """Many simulated labelled tables: how often the true rate of false rejection of the cutoffs chosen exceeds the limit."""
    rng, rows, runs = np.random.default_rng(4), [], 60
    for run in range(runs):
        for q, n in ((1, 700), (0, 60)):
            for symbol, word, design in zip(rng.beta(1, 60, n), rng.normal(5, 0.6, n) + 2 * (q == 0), rng.random(n) < 0.125):
                rows.append((f"s{run}", float(symbol), 0.0, 0.0, float(word), 0.0, q, bool(design)))
    labelled = spark.createDataFrame(rows, "stratum string, symbol_share double, dup_lines_per_100_words double, repeat_share double, mean_word double, upper_share double, quality int, design boolean")
    # Each run's own delta is its share of the strata's.
    found = rules.cutoffs(labelled, 0.05, 0.2 * runs).collect()
    symbol, word = rng.beta(1, 60, 400_000), rng.normal(5, 0.6, 400_000)
    rates = [((symbol > (r.cut_symbol_share or 9)) | (word > (r.cut_mean_word or 99))).mean() for r in found]
    assert len(found) > runs / 2 and max(rates) > 0.02 and sum(x > 0.05 for x in rates) <= 0.2 * runs


def test_binomial_tail(spark):
    from math import comb

    for n, k, p in ((10, 0, 0.1), (200, 7, 0.05), (1000, 30, 0.02)):
        got = spark.range(1).select(rules.binomial_tail(F.lit(n), F.lit(k), p).alias("x")).first().x
        assert abs(got - sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))) < 1e-9


def test_sketch_size_follows_the_texts():
    sizes = [substring.log_cells_for(n) for n in (0, 10**8, 10**9, 10**10, 10**13)]
    assert sizes == sorted(sizes) and sizes[0] == substring.LEAST_LOG_CELLS and sizes[-1] == substring.MOST_LOG_CELLS and len(set(sizes)) > 3


def test_keys_of_equal_windows_are_equal_wherever_they_stand():
    import pyarrow as pa

    from tracelake.llm.common import Words

    rng = random.Random(9)
    passage = " ".join(f"w{rng.randrange(50)}" for _ in range(60))
    found = []
    for before in (0, 7, 5000):
        at, gram_at, grams = substring._windows(Words(pa.array([" ".join(["x"] * before + [passage])])), 35)
        found.append(grams[gram_at[before:]].tolist())
    assert found[0] == found[1] == found[2] and len(found[0]) == 26


def test_urls_repeated_long_and_with_equal_rules(spark):
    rules = spark.createDataFrame([("a.com/", "block"), ("a.com/", "allow"), ("b.a.com/x/", "allow"), ("a.com/x/yz", "block"), (None, "block"), ("nopath", "block")], "rule string, verdict string")
    long = "http://a.com/" + "p/" * 50_000
    urls = [long, long, "http://b.a.com/x/yz", "http://c.a.com/x/yz", "http://a.com", None, "http:///x/"] + ["http://h.net/same"] * 300
    got = urlfilter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules)
    rows = {r.page_id: (r.rule, r.verdict) for r in got.collect()}
    assert len(rows) == got.count() == len(urls) and rows[0] == rows[1] == ("a.com/", "block")
    assert rows[2] == ("b.a.com/x/", "allow") and rows[3] == ("a.com/x/yz", "block") and {rows[i] for i in range(4, len(urls))} == {(None, "allow")}


def test_urls(spark):
    urls = ["http://WWW.Example.com/en/x?y", "https://a.net/es/", "http://b.org", "no url", None, "x://example.com/en/#f", "http://sub.example.com/", "http://notexample.com/en/", "http://a.net/es", "http://a.net/es/"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, rule int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, urlfilter.default_rules(spark)).collect()}
    assert got == {
        0: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 1: ("a.net", "/es/", "net/es/", "block"), 2: ("b.org", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("example.com", "/en/", "example.com/en/", "block"), 6: ("sub.example.com", "/", "com/", "allow"), 7: ("notexample.com", "/en/", "com/", "allow"), 8: ("a.net", "/es", None, "allow"), 9: ("a.net", "/es/", "net/es/", "block"),
    }
    assert urlfilter.judge(pages.limit(0), urlfilter.default_rules(spark)).count() == 0


def test_html(spark):
    page = '<html><head><title>t</title><script>x="</p>"</script></head><body><nav>menu</nav><div class="ad">buy</div>%s<footer>f &copy;</footer></body></html>'
    marked = page % "<article><h1>A &amp; B</h1><p>one <b>two<br>three\n\n four<p>five<aside>side</aside><div id=comments>me too</div></article>"
    bare = lambda x: page % f"<p>Same notice</p><p>{x}</p><p>Same end</p>"
    rows = [(1, "http://h.com/a", marked), (2, "http://h.com/b", marked), (3, "http://g.com/1", bare("own one")), (4, "http://g.com/2", bare("own two")), (5, "http://k.com/", bare("alone")), (6, None, None), (7, "http://e.com/", "")]
    got = {r.page_id: (r.text, r.n_chars) for r in htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"), 1).collect()}
    assert {i: t for i, (t, _) in got.items()} == {1: "A & B one two three four five", 2: "A & B one two three four five", 3: "own one", 4: "own two", 5: "Same notice alone Same end", 6: "", 7: ""}
    assert all(n == len(t) for t, n in got.values())


@pytest.mark.parametrize(
    "html, text",
    [
        ("<html><head><title>t</title><p>one<p>two", "one two"),
        ("<head><meta charset=utf-8>bare words", "bare words"),
        ('<div class="layout no-sidebar"><article>in</article></div>', "in"),
        ('<div id="page" class="post has-comments"><article>in</article></div>', "in"),
        ('<div class="content-sidebar-wrap"><main>in</main><div>out</div></div>', "in"),
        ('<form id="aspnetForm"><nav>n</nav><article>in</article></form>', "in"),
        ('<article>in <article class="comment">mine</article></article>', "in"),
        ('<article>in</article><section id="comments"><article id="comment-1">mine</article></section>', "in"),
        ('<main>in<div class="related-posts"><article class="teaser">other</article></div></main>', "in"),
        ('<article class="post category-advertising social-news">in</article>', "in"),
        ('<aside><article>out</article></aside><p>in', "in"),
        ('<ul><li class="ad">out<li>in</ul>', "in"),
        ('<article><table><tr><td class="ad">out<td>in<tr><td>more</table>', "in more"),
        ("<article><p>a &lt; b &amp;amp; c&nbsp;&#x41;</p><script>if (a<b) x='</p>'</script></article>", "a < b &amp; c A"),
        ("<p>" + "word " * 200_000 + "</p>", ("word " * 200_000).strip()),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<!-- <p>no</p> --><p>yes", "yes"), ("", ""), (None, ""), ("plain", "plain"),
    ],
)
def test_html_constructs(html, text):
    assert htmltext.main_text(htmltext.lines_of(html), []) == text


def test_html_differs_from_neighbours_whatever_the_partitions(spark):
    rng, rows = random.Random(8), []
    for i in range(120):
        host, path = rng.choice(["a.com", "a.com", "B.com", ""]), rng.choice(["/", "/x/", "/y/"]) + str(rng.randint(0, 30))
        lines = ["Menu"] + [f"line {rng.randint(0, 12)}" for _ in range(rng.randint(0, 6))] + ["End"]
        rows.append((i, f"http://{host}{path}" if host else None, "".join(f"<p>{x}</p>" for x in lines), "x", 1))
    rows += [(200 + i, "http://a.com/x/5", rows[0][2], "y", 2) for i in range(7)] + [(210, "http://a.com/x/5", None, "", 3), (200, "http://a.com/x/5", rows[0][2], "y", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, part int")
    place = lambda r: ((r[1] or "").removeprefix("http://").partition("/")[0].lower().encode(), "/" + (r[1] or "http:///").removeprefix("http://").partition("/")[2] if r[1] else "", r[0])
    content = {r[0]: h.h for r, h in zip(sorted(rows, key=lambda r: r[0]), pages.orderBy("page_id").select(F.xxhash64("html").alias("h")).collect())}
    order = sorted(rows, key=lambda r: (*place(r), content[r[0]]))
    want = []
    for k, r in enumerate(order):
        near = []
        for rest in (order[:k][::-1], order[k + 1 :]):
            other = next((x for x in rest if x[2] != r[2]), None)
            if other and place(other)[0] == place(r)[0]:
                near.append(htmltext.lines_of(other[2]))
        want.append((r[0], htmltext.main_text(htmltext.lines_of(r[2]), near)))
    for n in (1, 3, 40, 150):
        got = htmltext.extracted(pages, n).collect()
        assert sorted((r.page_id, r.text) for r in got) == sorted(want), n
    assert len({t for _, t in want}) > 60 and any("Menu" not in t for _, t in want)
    assert htmltext.extracted(pages.limit(0)).count() == 0


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(htmltext.common(a, b)) == best[-1][-1]


def test_mixing(docs, rows, empty):
    got = [r.asDict() for r in mixing.chosen(docs, share=0.6, most_epochs=2).collect()]
    tokens = {r[0]: len(words(r[1])) for r in rows}
    supply, used = {}, {}
    for i, t, lang, source, *_ in rows:
        leaf = ("books" if zlib.crc32(source.encode()) % 3 == 0 else "web", lang or "\0null", source)
        supply[leaf] = supply.get(leaf, 0) + len(words(t))
    for r in got:
        leaf = (r["domain"], r["lang"] or "\0null", r["source"])
        used[leaf] = used.get(leaf, 0) + r["n_tokens"]
    total = 0.6 * sum(supply.values())

    def fill(nodes, given):
        nodes, out = dict(nodes), {}
        while nodes:
            level = given / sum(w for w, _ in nodes.values())
            full = {k for k, (w, c) in nodes.items() if c < level * w}
            if not full:
                return out | {k: level * w for k, (w, c) in nodes.items()}
            for k in full:
                out[k] = nodes.pop(k)[1]
                given -= out[k]
        return out

    def weigh(level, name):
        return mixing.WEIGHTS[level].get(name, 1.0)

    budget = {(): total}
    for d, level in enumerate(mixing.LEVELS):
        for parent in [p for p in budget if len(p) == d]:
            kids = {leaf[: d + 1] for leaf in supply if leaf[:d] == parent and supply[leaf]}
            budget |= fill({k: (weigh(level, k[-1]), sum(2.0 * s for leaf, s in supply.items() if leaf[: d + 1] == k)) for k in kids}, budget[parent])
    for leaf, s in supply.items():
        assert used.get(leaf, 0) <= budget[leaf] + 1e-6 and used.get(leaf, 0) > budget[leaf] - max(9001, max(tokens.values()))
    assert all(r["epoch"] in (0, 1) for r in got) and mixing.mixed(empty).count() == 0 and mixing.chosen(empty).count() == 0


@pytest.mark.parametrize("sorted_rows", [4096, 3])
def test_mixing_takes_prefixes_of_the_seeded_order(spark, docs, monkeypatch, sorted_rows):
    """Of every leaf the rows of whole epochs and a prefix of the next: the longest within the budget. Null ids and columns of any name take part."""
    monkeypatch.setattr(mixing, "SORTED", sorted_rows)
    names = ["epochs", "prefix", "last", "place", "epoch", "domain", "_tokens", "_row", "_domain", "key"]
    many = docs.unionByName(docs.withColumns({"doc_id": F.lit(None).cast("long"), "text": F.concat("text", F.lit(" more"))}))
    many = many.withColumns({c: F.lit(7) for c in names})
    got = mixing.mixed(many, share=0.6)
    assert sorted(got.columns) == sorted(many.columns)
    rows = mixing.with_leaf(many, mixing._n_words().alias("n")).where("n > 0").withColumn("place0", mixing.place_of(F.lit(0), mixing.SEED)).withColumn("place1", mixing.place_of(F.lit(1), mixing.SEED)).collect()
    budget = {(r._domain, r._lang, r._source): r for r in mixing.plan(mixing.with_leaf(many, mixing._n_words().alias("_tokens")).where("_tokens > 0"), share=0.6).collect()}
    want = []
    for leaf, p in budget.items():
        own = [r for r in rows if (r._domain, r._lang, r._source) == leaf]
        want += [(r.doc_id, r._hash, e) for r in own for e in range(p.epochs)]
        place = (lambda r: r.place0) if p.epochs == 0 else (lambda r: r.place1)
        order = lambda r: (place(r).key, place(r).id is not None, place(r).id or 0, place(r).hash)
        rest, kin = p.budget - p.epochs * p.supply, {}
        for r in sorted(own, key=order):
            kin.setdefault((r.doc_id, r._hash), []).append(r)
        for same in kin.values():
            rest -= sum(r.n for r in same)
            if rest < 0 or p.epochs > 1:
                break
            want += [(r.doc_id, r._hash, p.epochs) for r in same]
    assert sorted(((r.doc_id, r.h, r.epoch) for r in got.select("doc_id", F.xxhash64("text").alias("h"), "epoch").collect()), key=str) == sorted(want, key=str)
    assert any(p.depth for p in budget.values()) == (sorted_rows == 3)
    taken = mixing.chosen(many, share=0.6)
    assert taken.count() == len(want) and got.select(*names[:4]).distinct().count() == 1


def test_mixing_of_a_leaf_depends_on_it_and_its_budget_alone(spark, monkeypatch):
    """The same leaf beside a small and a large one, at one budget: the same documents, whatever is sorted and how deep the ranges go."""
    table = lambda n: spark.createDataFrame([(i, "a b c d e", "en", "src0") for i in range(300)] + [(1000 + i, "a b c d e", "en", "src1") for i in range(n)], "doc_id long, text string, lang string, source string")
    found = []
    for n, most in ((300, 4096), (3000, 4096), (5000, 4096), (5000, 3)):
        monkeypatch.setattr(mixing, "SORTED", most)
        # The other leaf's weight is that of its supply, so this one's budget is always 600 tokens.
        rows = mixing.chosen(table(n), weights={"source": {"src0": 600.0, "src1": 2.0 * n}}, budget=600.0 + 2 * n).where("source = 'src0'").collect()
        found.append(sorted((r.doc_id, r.epoch) for r in rows))
    assert len(found[0]) == 120 and all(f == found[0] for f in found)


def test_rules_count_a_labelled_id_once(spark):
    """Ten times over, the same rows are no more evidence than once."""
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    once = spark.createDataFrame([(i, text(i), "en") for i in range(70)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(70)], "doc_id long, quality int")
    ten = once.crossJoin(spark.range(10)).drop("id")
    assert all(r.kept for r in rules.judged(once, labels).collect()) and all(r.kept for r in rules.judged(ten, labels).collect())


def test_packing_round_trip(spark, docs, rows, empty):
    packed = packing.packed(docs, length=256).collect()
    encoder = packing.Encoder(open(packing.TOKENIZER, "rb").read())
    parts = {}
    for r in packed:
        ids = packing.matrix([bytes(r.ids)], 256)[0]
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 256 and r.position_resets == r.cu_seqlens[:-1]
        for i, (doc, part) in enumerate(zip(r.doc_ids, r.parts)):
            parts.setdefault((doc, part), []).append(tuple(ids[r.cu_seqlens[i] : r.cu_seqlens[i + 1]]))
    for i, t, *_ in rows:
        if i not in (None, 3):
            whole = [x for k in range(len([p for p in parts if p[0] == i])) for x in parts[i, k][0]]
            assert whole == encoder.encode(t or "") + [packing.SEPARATOR]
    assert sum(r.n_tokens for r in packed) >= 0.9 * 256 * (len(packed) - 1) and packing.packed(empty).count() == 0


def test_encoder_equals_the_tokenizer_on_odd_spaces():
    encoder, rng = packing.Encoder(open(packing.TOKENIZER, "rb").read()), random.Random(2)
    for _ in range(500):
        t = "".join(rng.choices(["a", "bc", " ", "  ", "\n", "\t", "1", "'s", "!", "é", "\u00a0", "\u2003"], k=rng.randint(0, 12)))
        assert np.frombuffer(encoder.ids(t), packing.ID).tolist() == encoder.encode(t), repr(t)


def test_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(100):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(0, 40))]
        plain = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [(20 - sum(sizes[j] for j in b), -k) for k, b in enumerate(plain) if sum(sizes[j] for j in b) + sizes[i] <= 20]
            plain[-min(fits)[1]].append(i) if fits else plain.append([i])
        assert len(packing.best_fit(sizes, 20)) == len(plain) and sorted(i for b in packing.best_fit(sizes, 20) for i in b) == list(range(len(sizes)))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SF).cache())
        assert seen[-1].columns == docs.columns
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and len(ids[1]) > 0.6 * len(ids[0])
    marks = [fingerprint(r.text) for r in seen[2].collect()]
    assert len(set(components(list(range(len(marks))), marks))) == len(marks)
    leaked = {r.doc_id for r in decontam.leaks(seen[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids[3] == ids[2] - leaked
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {i for r in packed for i in r.doc_ids} == ids[4]
