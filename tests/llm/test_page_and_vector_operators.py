"""Operators over pages and vectors, and the pipeline, against plain versions."""

import base64
import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check
import corpus_pipeline
from sensorflow.llm import permutation_index, queries, secrets, tasks, tiling, url_filter, warc_bundles

HTML = "<p>é same</p>"
PAGES = [
    (1, "http://a.example.net/en/x?q=1", HTML), (2, "https://B.Example.COM/de/y#z", HTML), (3, None, None), (4, "no scheme", ""),
    (5, "http://x.org/fr/\r\nInjected: 1", HTML), (None, "http://n.net", HTML), (7, "http://net", "x" * 3_000_000),
    (5, "http://x.org/fr/\r\nInjected: 1", HTML), (8, "ftp://h?p=1&q=2", "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 3"),
]


@pytest.fixture(scope="module")
def pages(spark):
    tasks.prepare(spark)
    return spark.createDataFrame([(*p, "clash", 1, 2) for p in PAGES], "page_id long, url string, html string, host string, salt int, path int")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize(("frame_bytes", "least"), [(1, 0), (1 << 20, 0), (1 << 20, 1)])
def test_bundles(spark, pages, frame_bytes, least):
    index = warc_bundles.write_bundles(pages, tasks.work_path(spark, "test"), least, frame_bytes)
    found = warc_bundles.read_bundles(index).collect()
    last = {}
    for i, _, html in PAGES:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", 0))
    wanted = []
    for i, _, html in PAGES:
        body = html or ""
        revisit = body in last and i != last[body] and len(body) >= least
        wanted.append((i, len(body.encode()), digest(html), "revisit" if revisit else "response", last[body] if revisit else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    bodies = {i: (html or "").encode() for i, _, html in PAGES}
    assert all((r.payload is None) == (r.record_type == "revisit") for r in found)
    assert all(r.payload is None or bytes(r.payload) == bodies[r.page_id] for r in found)
    assert {r.page_id: r.url for r in found}[5] == "http://x.org/fr/%0D%0AInjected:%201"
    for path in {r.path for r in index.collect()}:
        sizes = warc_bundles.frames(path)
        assert tasks.file_size(path) == sum(s for _, s, _ in sizes) + 8 + 8 * len(sizes) + 9


def test_lookup_reads_single_records(spark, pages):
    index = warc_bundles.write_bundles(pages, tasks.work_path(spark, "test"), frame_bytes=100)
    name = warc_bundles.record_id(7, digest("x" * 3_000_000))
    ids = spark.createDataFrame([(name,), (name,), ("<urn:page:0:none>",)], "record_id string")
    row, = warc_bundles.lookup(index, ids).collect()
    assert row.page_id == 7 and len(row.payload) == 3_000_000
    assert warc_bundles.archive(spark, pages.filter("false")).count() == 0


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules):
    fitting = []
    for verdict, text in rules:
        rule_host, _, rule_path = text.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            fitting.append((len(text), text, verdict))
    return max(fitting)[1:] if fitting else (None, None)


URLS = [
    "http://a.example.net/en/x", "http://example.net/de/", "https://EXAMPLE.com/de/1?x=/fr/", "http://example.com/de", "http://net", "http://net/",
    "http://x.net?y=/", "http://éa.org/fr/", "http://xorg/fr/", "http://org/fr/a#b", "a://b://c.net/d", "://", "", None, "nothing", "http://I.Example.net:80/en/",
    "http://h/" + "a1-" * 50_000, "http://q.org/fr?a=1&b=2;c", "http://q.net/?a=1&b=2;c#d", "http://q.net/%20%41",
]


def test_urls(spark):
    tasks.prepare(spark)
    rows = [(i, u, "c", 1) for i, u in enumerate(URLS)] + [(0, URLS[0], "c", 1), (None, URLS[1], "c", 1)]
    found = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string, host string, n int")).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path = plain_parts(r.url)
        rule, verdict = plain_rule(host, path, url_filter.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judged(empty).count() == 0
    none = url_filter.judged(spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")).first()
    assert (none.verdict, none.method) == ("allow", "default")
    only = url_filter.judged(spark.createDataFrame([(1, "http://a.b/c"), (2, "http://b.net/")], "page_id long, url string")).collect()
    assert {r.verdict for r in only} == {"block"}


def test_url_features(spark):
    rows = spark.createDataFrame([(1, "http://a-b.c1.net/x/y?p=1&q=2#z"), (2, None)], "page_id long, url string")
    first, second = url_filter.with_features(url_filter.with_parts(rows)).orderBy("page_id").collect()
    url = "http://a-b.c1.net/x/y?p=1&q=2#z"
    entropy = -sum(url.count(c) / len(url) * math.log2(url.count(c) / len(url)) for c in set(url))
    assert abs(first.entropy - entropy) < 1e-9 and abs(first.digits - 3 / len(url)) < 1e-12
    assert (first.n_chars, first.depth, first.labels, first.dashes, first.parameters) == (len(url), 2, 3, 1, 2)
    assert (second.n_chars, second.depth, second.labels, second.entropy, second.parameters) == (0, 0, 0, 0, 0)


def test_trees_learn_what_rules_say(spark, small):
    rows = spark.read.parquet(f"{small}/../sf0.1/pages.parquet")
    rules = [("block", "net/"), ("allow", "com/")]
    found = url_filter.judged(rows, rules).collect()
    assert {r.method for r in found} == {"rule", "trees"}
    # Trees that see urls of the rules' hosts again agree with the rules.
    known = [url_filter.Rule(*r) for r in rules]
    labelled = url_filter.with_features(url_filter.with_rule(url_filter.with_parts(rows.select("page_id", "url")), known)).filter("ruled IS NOT NULL")
    shares = tasks.written(url_filter.suffix_shares(labelled), "shares")
    model = url_filter.trained(url_filter.with_shares(labelled, shares), labelled.count())
    made = model.transform(url_filter.with_shares(labelled, shares)).select("ruled", "_blocked").collect()
    assert sum((r._blocked > 0.5) == (r.ruled == "block") for r in made) > 0.95 * len(made)


def test_training_sample_with_hot_urls(spark):
    tasks.prepare(spark)
    hot = spark.range(3000).selectExpr("id AS page_id", "'http://a.net/' AS url")
    few = hot.unionByName(spark.createDataFrame([(-1, "http://b.example.com/de/"), (-2, "http://c.org/fr/"), (-3, "http://d.edu/")], "page_id long, url string"))
    assert {r.method for r in url_filter.judged(few, train_rows=10).select("method").distinct().collect()} == {"rule", "trees"}
    assert {r.method for r in url_filter.judged(few, train_rows=0).filter("rule IS NULL").collect()} <= {"default", "trees"}
    many = hot.unionByName(spark.range(6000).selectExpr("id AS page_id", "concat('http://h', id, if(id % 3 = 0, '.net/', '.org/fr/')) AS url"))
    rows = url_filter.with_features(url_filter.with_rule(url_filter.with_parts(many), [url_filter.Rule(*r) for r in url_filter.RULES]))
    sample = url_filter.sampled(rows.withColumn("suffix_share", F.lit(0.5)), 9000, 1000).toPandas()
    assert 850 < len(sample) < 1150 and 400 < sample.blocked.sum() < 600
    # The copies of one url are one row, with their weight.
    assert url_filter.sampled(rows.filter("url = 'http://a.net/'").withColumn("suffix_share", F.lit(0.5)), 3000, 1000).toPandas().weight.tolist() == [1.0]


def test_rules_on_the_table(spark, small):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{small}/pages.parquet'")
    for name in ("op1_warc_bundles", "op3_near_dedup"):
        db.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
        good, note = check.compare(spark, db, name, small)
        assert good, note


# --- vectors -------------------------------------------------------------------------------------------------------------

def plain_search(rows, every=50, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    sizes = [len(v) for _, v in good]
    size = min(sizes, key=lambda s: (-sizes.count(s), s)) if sizes else 0
    good = [(i, v) for i, v in good if len(v) == size]
    wanted = []
    for i, a in sorted(set((i, tuple(v)) for i, v in good)):
        if i % every == 0:
            a = np.array(a)
            scores = sorted((-float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), j) for j, b in good if j != i)
            wanted += [(i, n + 1, j, round(-s, 9)) for n, (s, j) in enumerate(scores[:k])]
    return sorted(wanted)


def searched(spark, rows):
    table = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 0, "x") for i, v in rows], "vec_id long, embedding array<double>, class int, vector string")
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in permutation_index.search(table).collect())


def test_small_vectors_are_searched_exactly(spark):
    tasks.prepare(spark)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1, 140)]
    rows += [(i, [1.0, 2, 3, 4, 5, 6]) for i in range(150, 250)]  # more equal ones than asked for
    rows += [(0, None), (300, [0.0] * 6), (350, [1.0, None, 0, 0, 0, 0]), (400, [float("nan")] * 6), (450, [1.0] * 5), (500, []), (550, [math.inf] * 6),
             (None, [1.0] * 6), (600, [1e300] * 6)]
    assert [r[:3] for r in searched(spark, rows[:-1])] == [r[:3] for r in plain_search(rows[:-1])]
    assert {r[0] for r in searched(spark, rows)} >= {600}
    for few in ([], [(50, [1.0, 0])], [(50, [1.0, 0]), (1, [0.5, 0.5]), (2, [-1.0, 0])]):
        assert searched(spark, few) == plain_search(few)


def test_each_length_is_searched(spark):
    tasks.prepare(spark)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=(6, 4, 4)[i % 3]).tolist()) for i in range(150)]
    lengths = [[r for r in rows if len(r[1]) == n] for n in (4, 6)]
    assert [r[:3] for r in searched(spark, rows)] == sorted(r[:3] for part in lengths for r in plain_search(part))


def test_recall(spark, small):
    path = f"{small}/../sf0.1/embeddings.parquet"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(path).collect()]
    found = queries.QUERIES["op10_permutation_index"](spark, f"{small}/../sf0.1").collect()
    wanted = {r[:1] + r[2:3] for r in plain_search(rows)}
    got = {(r.query_id, r.vec_id) for r in found}
    assert len(got) == len(wanted) and len(got & wanted) >= 0.9 * len(wanted)


def test_recall_with_a_third_of_near_copies(spark):
    tasks.prepare(spark)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(6000, 64))
    copies = rng.permutation(6000)[:2000]
    vectors[copies] = rng.normal(size=64) + 0.05 * rng.normal(size=(2000, 64))
    table = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    rows = permutation_index.search(table).collect()
    found = {(r.query_id, r.vec_id) for r in rows}
    assert len(rows) == 5 * 120 and np.mean([r.compared for r in rows]) < 6000 / 4
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for wanted in (set(range(0, 6000, 50)) & set(copies.tolist()), set(range(0, 6000, 50)) - set(copies.tolist())):
        scores = units[sorted(wanted)] @ units.T
        true = {(q, int(i)) for q, s in zip(sorted(wanted), scores, strict=True) for i in [i for i in np.argsort(-s)[:6] if i != q][:5]}
        assert len(true) == 5 * len(wanted) and len(true & found) >= 0.9 * len(true)


def test_places_and_footrule():
    rng = np.random.default_rng(4)
    vectors, centres = rng.normal(size=(40, 8)), permutation_index.normal(rng.normal(size=(20, 8)))
    at = permutation_index.places(vectors, centres, 12)
    for v, found in zip(vectors, at, strict=True):
        order = sorted(range(20), key=lambda p: (-float(permutation_index.normal(v[None, :])[0] @ centres[p]), p))
        assert found.tolist() == [min(order.index(p), 12) for p in range(20)]
    wanted = [sum(abs(int(a) - int(b)) for a, b in zip(x, at[0], strict=True)) for x in at]
    assert permutation_index.footrule(at, at[0]).tolist() == wanted


def test_pivots_lie_apart():
    rng = np.random.default_rng(5)
    units = permutation_index.normal(np.concatenate([rng.normal(size=16) + 0.01 * rng.normal(size=(300, 16)), rng.normal(size=(100, 16))]))
    chosen = permutation_index.pivots(units, 50)
    assert len(chosen) == 50 and (chosen @ units[0] > 0.9).sum() == 1
    assert len(permutation_index.pivots(units[:300], 50)) == 50  # none lie apart: copies have to do


def test_queries_without_a_near_file_are_compared_with_all(spark):
    tasks.prepare(spark)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(900)]
    tight = permutation_index.Settings(posts=1, probes=1, share=0.0, least=1)
    found = permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tight).collect()
    assert len(found) == 5 * 18
    short = {r.query_id for r in found if r.compared == 900}
    wanted = {r[:3] for r in plain_search(rows) if r[0] in short}
    assert short and wanted == {(r.query_id, r.rank, r.vec_id) for r in found if r.query_id in short}


# --- pipeline --------------------------------------------------------------------------------------------------------------

def test_pipeline(spark, small):
    tasks.prepare(spark)
    docs = tasks.table(spark, small, "documents")
    schema = docs.schema
    good = tasks.table(spark, small, "labels").filter("quality = 1")
    text = docs.join(good, "doc_id").orderBy("doc_id").first().text  # once more, without an id
    docs = docs.unionByName(spark.createDataFrame([(None, " ".join(sorted(text.split())), "en", "s", 19), (-1, None, None, None, None)], schema))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = tasks.written(stage(spark, docs, small), "test")
        seen[name] = before, docs
        if name != "encoding":
            assert docs.columns == schema.fieldNames()
            assert docs.filter("doc_id IS NULL").count() == 1
    counts = [after.count() for _, after in seen.values()]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * before.count()
    before, after = seen["decontamination"]
    flagged = {r.doc_id for r in tiling.contaminated(before, tasks.table(spark, small, "benchmark")).collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - flagged
    before, after = seen["secrets"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id for r in after.collect()} == set(texts)
    for r in after.collect():
        assert not secrets.spans(r.text) or secrets.MASK in r.text
        if not secrets.spans(texts[r.doc_id]):
            assert r.text == texts[r.doc_id]
    assert corpus_pipeline.run(spark, small).count() >= counts[-1] - 2


def test_rows_that_share_or_lack_an_id(spark):
    words = lambda n: " ".join(f"w{n}x{i}" for i in range(40))
    rows = [(1, words(1), "a"), (1, words(2), "a"), (1, words(2), "b"), (1, None, "a"), (2, words(3), "a"), (3, words(3) + " more", "a"),
            (None, words(4), "a"), (None, words(4), "a"), (None, words(5), "a"), (None, words(3), "a"), (None, None, "a"), (4, words(1), "a")]
    first = min(words(1), words(2), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    one = 1 if first == words(1) else 4  # who has the text of both 1 and 4
    wanted = {(one, words(1)), (1, words(2)), (1, None), (2, words(3)), (None, words(4)), (None, words(5)), (None, None)}
    for shuffled in (rows, rows[::-1]):
        docs = spark.createDataFrame(shuffled, "doc_id long, text string, source string")
        found = [tuple(r) for r in corpus_pipeline.one_of_each(spark, docs, "").collect()]
        assert len(found) == len(wanted) and {r[:2] for r in found} == wanted
        assert shuffled is rows or sorted(found, key=str) == before
        before = sorted(found, key=str)


def test_stages_leave_other_columns_alone(spark, small):
    """Names that stages use inside, a map column, empty tables, null texts and repeated rows."""
    tasks.prepare(spark)
    made = spark.read.parquet(f"{small}/documents.parquet").limit(60).selectExpr(
        "doc_id", "text", "'h' AS hash", "'r' AS row", "'f' AS `first`", "1 AS at", "2 AS id", "3 AS salt", "map('k', doc_id) AS m", "doc_id AS document")
    odd = spark.range(4).selectExpr("id + 900000 AS doc_id", "CAST(NULL AS string) AS text", "'h' AS hash", "'r' AS row", "'f' AS `first`", "1 AS at",
                                    "2 AS id", "3 AS salt", "map('k', id) AS m", "id AS document")
    docs = tasks.written(made.unionByName(odd), "odd")
    before = {r.doc_id: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, small)
        assert rows.columns == docs.columns and stage(spark, docs.filter("false"), small).count() == 0
        for r in rows.collect():
            was = before[r.doc_id]
            assert (r.hash, r.row, r["first"], r["at"], r.id, r.salt, r.m, r.document) == (was.hash, was.row, was["first"], was["at"], was.id, was.salt, was.m, was.document)
        docs = tasks.written(rows, "odd")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() == docs.count() > 0
