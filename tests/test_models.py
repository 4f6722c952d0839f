import datetime
import decimal
import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.operators import learning, merge, quantised, search
from strata.operators.enrich import store_profiles
from strata.operators.governance import AccessDenied, GovernedView
from strata.plans import corpus, governed_files, purchases, retrieval, revenue
from tests.conftest import rows


# --- vector search -------------------------------------------------------------


def brute(base, queries, k):
    found = []
    for qid, q in queries:
        scored = []
        for vid, v in base:
            n = np.linalg.norm(v) * np.linalg.norm(q)
            if n > 0:
                scored.append((round(float(1 - np.dot(v, q) / n), 9), vid))
        found += [(qid, i + 1, vid, d) for i, (d, vid) in enumerate(sorted(scored)[:k])]
    return sorted(found)


def vectors(count, size, seed):
    draw = np.random.default_rng(seed)
    return [(i, [float(x) for x in draw.normal(size=size).round(3)]) for i in range(count)]


@pytest.fixture
def base(spark):
    data = vectors(400, 8, 1) + [(i, [1.0] * 8) for i in range(400, 600)]  # a third are copies
    data += [(600, [0.0] * 8)]
    return data, spark.createDataFrame(data, "id bigint, embedding array<float>").repartition(6)


@pytest.mark.parametrize("blocks", [(1 << 16, 1 << 14, 0), (70, 3, 0), (70, 3, 1 << 10)])
def test_exact_search_equals_brute_force(spark, base, blocks, monkeypatch):
    monkeypatch.setattr(search, "BASE_BLOCK", blocks[0])
    monkeypatch.setattr(search, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(search, "FEW_QUERIES", blocks[2])  # 0: none are few
    data, frame = base
    asked = vectors(9, 8, 2) + [(9, [2.0] * 8)]
    queries = spark.createDataFrame(asked, "q int, embedding array<double>")
    found = search.nearest_exact(frame, queries, 5, "id", "q")
    got = sorted((r.q, r.rank, r.id, round(r.distance, 9)) for r in found.collect())
    assert [g[:3] for g in got] == [b[:3] for b in brute(data, asked, 5)]
    assert max(abs(g[3] - b[3]) for g, b in zip(got, brute(data, asked, 5))) < 1e-6
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("MapInArrow" in plan) == bool(blocks[2]) == ("CoGroup" not in plan)
    contract = search.search_contract(found, "q").first()
    assert tuple(contract) == (50, 0, 0)
    assert search.nearest_exact(frame, queries.limit(0), 5, "id", "q").count() == 0
    assert search.nearest_exact(frame.limit(0), queries, 5, "id", "q").count() == 0
    few = search.nearest_exact(frame.filter("id < 3"), queries, 5, "id", "q")
    assert few.count() == 30  # fewer vectors than neighbours asked for


def table_of(data, ids, name):
    return pa.table({ids: pa.array(list(range(len(data)))), name: pa.array(list(data), pa.list_(pa.float32()))})


def test_a_group_is_searched_in_tiles_of_bounded_size():
    """a task held several matrices as wide as its whole block of base rows."""
    draw = np.random.default_rng(7)
    data = draw.normal(size=(40000, 8)).round(1).astype("float32")  # copies and ties beyond one tile
    data[::9] = data[5]
    data[::1000] = 0
    groups = table_of(data, "id", "embedding"), table_of(data[:600], "__query", "__vector")
    tracemalloc.start()
    found = search._nearest_in_group(3, "embedding", ["id"])(*groups)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # 256 rows of 40,000 distances alone have 78 MB
    got = found.group_by("__query").aggregate([("id", "list"), ("distance", "list")]).to_pydict()
    assert sorted(got["__query"]) == list(range(1, 600))  # a vector of length zero finds nothing
    units = search._unit_rows(data.astype("float64"))
    for query, ids, near in zip(got["__query"], got["id_list"], got["distance_list"]):
        distance = np.clip(np.round(1 - units @ units[query], search.DISTANCE_DIGITS), 0, 2)
        want = np.lexsort((np.arange(len(data)), distance))[:3]  # NaN goes last
        assert sorted(zip(near, ids)) == [(distance[i], i) for i in want]


def test_tiles_give_what_one_matrix_gives(monkeypatch):
    draw = np.random.default_rng(3)
    for rows, k, low, high in ((1, 3, 0, 2), (50, 4, 0, 2), (50, 60, -math.inf, math.inf), (7, 2, -math.inf, math.inf)):
        similarity = draw.integers(-9, 9, (20, rows)) / 4.0
        similarity[draw.random((20, rows)) < 0.2] = np.nan
        for tile in (1, 6, 100):
            monkeypatch.setattr(search, "ROWS_AT_ONCE", tile)
            found = search.nearest_by_tiles(
                lambda first, last: ((slice(at, at + 8), similarity[at: at + 8, first:last]) for at in range(0, 20, 8)),
                20, rows, k, low, high)
            distance = np.clip(np.round(1 - similarity, search.DISTANCE_DIGITS), low, high)
            distance[np.isnan(distance)] = np.inf
            assert sorted(zip(*found)) == sorted(zip(*search.nearest_columns(distance, k)))


def test_vectors_of_unequal_length_are_refused(spark):
    queries = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0])], "q int, embedding array<double>")
    odd = spark.createDataFrame([(1, [1.0] * 3), (2, [1.0] * 5)], "id int, embedding array<double>")
    for base in (odd, odd.filter("id = 1")):
        with pytest.raises(Exception, match="vectors of different lengths"):
            search.nearest_exact(base, queries, 1, "id", "q").collect()
    null = spark.createDataFrame([(1, None), (2, [0.0, 1.0, 0.0, 0.0])], "id int, embedding array<double>")
    assert rows(search.nearest_exact(null, queries, 2, "id", "q"), "id") == [(2,)]


def test_given_centres_and_a_base_read_once(spark, base):
    data, frame = base
    centres = np.array([v for _, v in vectors(4, 8, 9)])
    index = search.cluster_by_centres(frame, centres, "id")
    nearest = {r.id: r.cluster_id for r in index.rows.collect()}
    for i, v in data[:50]:
        distances = [round(float(1 - np.dot(v, c) / np.linalg.norm(v) / np.linalg.norm(c)), 12) for c in centres]
        assert nearest[i] == int(np.argmin(distances))
    found = search.nearest_exact(frame, frame.select(F.col("id").alias("q"), "embedding"), 2, "id", "q")
    assert found.count() == 2 * 600  # the zero vector finds nothing


def test_index_probed_whole_is_exact_and_in_part_mostly(spark, base, folder):
    _, frame = base
    queries = spark.createDataFrame(vectors(8, 8, 3), "q int, embedding array<double>")
    index = search.build_cluster_index(frame, 6)
    assert index.rows.count() == 600  # the zero vector has no cluster
    exact = search.nearest_exact(frame, queries, 5, "id", "q")
    whole = search.nearest_indexed(index, queries, 5, "id", "q", probes=6)
    assert rows(whole) == rows(exact)
    part = search.nearest_indexed(index, queries, 5, "id", "q", probes=3)
    stored = search.load_index(spark, search.store_index(index, f"{folder}/index"))
    pruned = search.nearest_indexed(stored, queries.filter("q = 0"), 5, "id", "q", probes=1)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cluster_id" in plan
    assert rows(search.nearest_indexed(stored, queries, 5, "id", "q", probes=3)) == rows(part)
    recall = search.recall(part, exact, "q", "id").agg(F.avg("recall")).first()[0]
    assert recall >= 0.5


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_index_finds_the_neighbours_of_ordinary_vectors(spark, size):
    import __spark_entry__ as contract

    found = contract.queries()["vector_topk_indexed_ordinary"](spark, f"/root/testdata/{size}")
    per_query = found.select("query_vec", "recall").distinct()
    asked = spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet").filter("vec_id % 50 = 0")
    assert per_query.count() == asked.count()
    assert per_query.agg(F.avg("recall")).first()[0] >= 0.9


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_quantised_index_finds_neighbours_and_reads_few_vectors(spark, size):
    from strata.registry import retrieval as queries

    folder = f"/root/testdata/{size}"
    found, exact = queries.quantised_search(spark, folder)
    assert search.recall(found, exact, "query_vec", "vec_id").agg(F.avg("recall")).first()[0] >= 0.9
    vectors_known = spark.read.parquet(f"{folder}/embeddings.parquet").count()
    assert queries.RERANK * 4 <= vectors_known


def test_codes_and_search_equal_brute_force(spark, base, folder):
    data, frame = base
    index = quantised.build_quantised_index(frame, f"{folder}/pq", "id", clusters=6, parts=2, words=8)
    assert index.codes.count() == index.vectors.count() == 600  # the zero vector is not in it
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in data if np.linalg.norm(v)}
    for r in index.codes.collect():
        u = units[r.id]
        cell = int(np.argmin([round(1 - u @ c, 12) for c in index.centres]))
        rest = (u - index.centres[cell]).reshape(2, -1)
        words = [int(np.argmin([round(np.linalg.norm(p - w), 12) for w in book])) for p, book in zip(rest, index.books)]
        assert (r.cluster_id, list(r.code)) == (cell, words)
    asked = vectors(9, 8, 3)
    queries = spark.createDataFrame(asked, "q int, embedding array<double>")
    whole = quantised.nearest_quantised(index, queries, 5, "id", "q", probes=6, rerank=600)
    assert sorted((r.q, r.rank, r.id) for r in whole.collect()) == [b[:3] for b in brute(data, asked, 5)]
    few = quantised.nearest_quantised(index, queries, 5, "id", "q", probes=2, rerank=7)
    for q, v in asked:
        u = np.array(v) / np.linalg.norm(v)
        cells = np.argsort([round(1 - u @ c, 12) for c in index.centres], kind="stable")[:2]
        scores = sorted((round(1 - float(u @ (index.centres[r.cluster_id] + np.concatenate(
            [book[w] for book, w in zip(index.books, r.code)]))), 12), r.id)
            for r in index.codes.collect() if r.cluster_id in cells)[:7]
        best = sorted((round(1 - float(u @ units[i]), 12), i) for _, i in scores)[:5]
        assert [r.id for r in few.filter(f"q = {q}").orderBy("rank").collect()] == [i for _, i in best]
    assert quantised.nearest_quantised(index, queries.limit(0), 5, "id", "q", 2, 7).count() == 0


def test_search_over_many_partitions_loses_nothing(spark, base):
    data, frame = base
    asked = vectors(9, 8, 2)
    queries = spark.createDataFrame(asked, "q int, embedding array<double>")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        index = search.cluster_by_centres(frame, np.array([v for _, v in vectors(4, 8, 9)]), "id")
        for found in (search.nearest_exact(frame, queries, 5, "id", "q"),
                      search.nearest_indexed(index, queries, 5, "id", "q", probes=4)):
            got = sorted((r.q, r.rank, r.id) for r in found.collect())
            assert got == [b[:3] for b in brute(data, asked, 5)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_mean_vectors(spark):
    frame = spark.createDataFrame(
        [(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "k int, embedding array<float>")
    assert rows(search.mean_vectors(frame, "k")) == [(1, [2.0, 3.0]), (2, [5.0, 6.0])]


def test_text_search_end_to_end(spark, folder):
    posts = spark.createDataFrame(
        [(1, "Rye bread", "<p>knead rye dough twice</p>", "Baking|grain", 9),
         (2, "Pea soup", "<p>boil green peas until soft</p>", "soup", 5),
         (3, "Clean a pan", "salt", "tools", 99), (4, None, "x", "stew", 7), (5, "T", None, "stew", 7)],
        "id bigint, title string, body string, tags string, score bigint")
    documents = search.top_documents(posts, "(soup|baking|stew)")
    assert [r.document_id for r in documents.collect()] == ["1", "2"]
    assert search.top_documents(posts, "stew|soup|baking", limit=1).count() == 1
    embedded = retrieval.document_embeddings(documents)
    assert len(embedded.first().embedding) == search.DIMENSIONS
    question = retrieval.query_embeddings(
        spark.createDataFrame([(0, "dough that you knead")], "query_id int, content string"))
    results = retrieval.search(embedded, question, 2)
    assert [r.document_id for r in results.orderBy("rank").collect()] == ["1", "2"]
    assert all(r.ok for r in retrieval.verify(results).collect())
    indexed = retrieval.search(retrieval.index(embedded, 2, f"{folder}/index"), question, 2, probes=2)
    assert rows(indexed) == rows(results)
    none = retrieval.verify(results.limit(0))
    assert not all(r.ok for r in none.collect())


def test_embedding_status_and_plugged_model(spark):
    frame = spark.createDataFrame([(1, "a b a"), (2, "  "), (3, None)], "id int, content string")
    default = {r.id: r for r in search.embed_texts(frame).collect()}
    assert [default[i].status for i in (1, 2, 3)] == ["", "empty content", "empty content"]
    assert math.isclose(sum(x * x for x in default[1].embedding), 1.0, rel_tol=1e-6)
    assert sorted(x for x in default[1].embedding if x)[0] == pytest.approx(1 / math.sqrt(5))

    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [float(len(t)), 1.0])

    plugged = search.embed_texts(frame, embedder=lengths)
    assert search.embedded_rows(plugged).first().embedding == [5.0, 1.0]


# --- learning -------------------------------------------------------------------


def test_binary_metrics_equal_brute_force(spark):
    draw = random.Random(5)
    data = [(draw.randint(0, 20) / 20, int(draw.random() < 0.4)) for _ in range(700)]
    frame = spark.createDataFrame(data, "s double, y int").repartition(4)
    got = learning.binary_metrics(frame, "y", "s").first()
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    tp, fp = sum(s >= 0.5 for s in pos), sum(s >= 0.5 for s in neg)
    assert got.roc_auc == pytest.approx(wins / len(pos) / len(neg))
    assert got.precision == pytest.approx(tp / (tp + fp))
    assert got.recall == pytest.approx(tp / len(pos))
    assert got.accuracy == pytest.approx((tp + len(neg) - fp) / 700)
    one_class = learning.binary_metrics(frame.filter("y = 1"), "y", "s").first()
    assert one_class.roc_auc is None


SESSIONS = ("fullVisitorId string, suffix string, totals struct<bounces:bigint,timeOnSite:bigint,"
            "pageviews:bigint,transactions:bigint>, trafficSource struct<source:string,"
            "medium:string>, device struct<deviceCategory:string>, geoNetwork struct<country:string>")


def test_purchase_prediction(spark):
    draw = random.Random(11)
    data = []
    for i in range(900):
        buyer = draw.random() < 0.2
        time_on = draw.gauss(300 if buyer else 100, 60)
        suffix = ("20161105", "20170515", "20170710")[i % 3]
        data.append((f"v{i % 200}", suffix, (None, int(time_on), i % 9, 1 if buyer else None),
                     ("s%d" % (i % 3), None), ("mobile",), ("BR",)))
    frame = spark.createDataFrame(data, SESSIONS)
    features = learning.session_features(frame)
    first = features.first()
    assert first.bounces == 0 and first[learning.LABEL] in (0, 1)
    weights = {r.y: r.w for r in learning.with_class_weights(features).groupBy(
        F.col(learning.LABEL).alias("y")).agg(F.max("weight").alias("w")).collect()}
    ones = features.filter(f"{learning.LABEL} = 1").count()
    assert weights == {1: pytest.approx(450 / ones), 0: pytest.approx(450 / (900 - ones))}
    trained = purchases.run(frame)
    assert trained.metrics().first().roc_auc > 0.9
    assert all(r.ok for r in purchases.verify(trained).collect())
    visitors = trained.predictions
    assert visitors.count() == visitors.select("visitor_id").distinct().count()
    assert visitors.filter("transaction_probability NOT BETWEEN 0 AND 1").count() == 0


def test_newton_steps_equal_a_plain_fit(spark):
    draw = random.Random(12)
    data = [(f"v{i}", "20161105", (None, int(draw.gauss(100, 30)), i % 9, 1 if draw.random() < 0.1 + 0.02 * (i % 9) else None),
             (f"s{i % 5}", None), ("mobile" if i % 2 else "desktop",), (("BR", "DE", "")[i % 3],)) for i in range(400)]
    features = learning.session_features(spark.createDataFrame(data, SESSIONS))
    model = learning.train(features, positions=16)
    rows_ = features.select("*", *[learning.category_position(c, 16).alias(f"p_{c}") for c in learning.CATEGORICAL]).collect()
    numbers = np.array([[r[c] for c in learning.NUMERIC] for r in rows_], float)
    spread = numbers.std(0, ddof=1)
    x = np.zeros((len(rows_), 20))
    x[:, 0] = 1
    x[:, 1:4] = (numbers - numbers.mean(0)) / np.where(spread > 0, spread, 1)
    for i, r in enumerate(rows_):
        for c in learning.CATEGORICAL:
            x[i, 4 + r[f"p_{c}"]] += 1
    y = np.array([r[learning.LABEL] for r in rows_], float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    held, beta = np.append(0, np.ones(19)) * learning.RIDGE, np.zeros(20)
    for _ in range(learning.NEWTON_STEPS):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve(x.T @ np.diag(weight * p * (1 - p)) @ x + np.diag(held), x.T @ (weight * (y - p)) - held * beta)
    assert np.allclose(model.weights, beta, atol=1e-8)
    assert np.abs(x.T @ (weight * (y - 1 / (1 + np.exp(-x @ beta)))) - held * beta).max() < 1e-6  # no way up is left
    scored = {r.visitor_id: r.probs[0].prob for r in learning.predict(model, features).collect()}
    for r, p in zip(rows_, 1 / (1 + np.exp(-x @ beta))):
        assert scored[r.visitor_id] == pytest.approx(p, abs=1e-8)
    one_class = learning.train(features.filter(f"{learning.LABEL} = 0"), positions=4)
    assert np.isfinite(one_class.weights).all()
    assert np.isfinite(learning.train(features.limit(0), positions=4).weights).all()


@pytest.mark.parametrize("auc, ok", [(0.73, True), (0.5, False)])
def test_metric_gate(spark, auc, ok):
    from strata.operators.quality import gate

    frame = spark.createDataFrame([(0.31, 0.88, auc)], "precision double, recall double, roc_auc double")
    assert gate(frame, purchases.METRIC_GATE).filter("NOT ok").count() == (0 if ok else 1)


# --- merges ----------------------------------------------------------------------


def test_upserts(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, v string, n int")
    incoming = spark.createDataFrame([(2, None, 7), (3, "c", 1)], "k int, v string, n int")
    assert rows(merge.upsert(target, incoming, ["k"])) == [
        (1, "a", None), (2, None, 7), (3, "c", 1)]
    assert rows(merge.insert_absent(target, incoming, ["k"])) == [
        (1, "a", None), (2, "b", 5), (3, "c", 1)]
    assert rows(merge.upsert(target, incoming.limit(0), ["k"])) == rows(target)


def test_profiles_keep_the_newest_version(spark, folder):
    versions = spark.createDataFrame(
        [("u-71", "Pebble", 1), ("u-71", "Pebble two", 2), ("u-72", "Heron", 1)],
        "player_id string, display_name string, version int")
    assert store_profiles(versions, "player_id", "version", f"{folder}/profiles") == 2
    stored = spark.read.parquet(f"{folder}/profiles")
    assert rows(stored) == [("u-71", "Pebble two"), ("u-72", "Heron")]


# --- SQL workflow ------------------------------------------------------------------


def test_corpus_workflow(spark):
    counts = spark.createDataFrame(
        [("The", "hamlet", 150), ("the", "hamlet", 900), ("king", "hamlet", 100),
         ("rare", "hamlet", 99), ("the", "lear", 700)],
        "word string, corpus string, word_count bigint")
    flow = corpus.run(counts)
    assert rows(flow.staged.groupBy("corpus").count()) == [("hamlet", 3), ("lear", 1)]
    summary = {r.corpus: r for r in flow.summary.collect()}
    assert summary["hamlet"].distinct_words == 2 and summary["hamlet"].total_occurrences == 1150
    assert [(w.word, w.word_count) for w in summary["hamlet"].top_words] == [
        ("the", 900), ("the", 150), ("king", 100)]
    assert flow.report.agg(F.sum("violations")).first()[0] == 0
    holes = counts.withColumn("word", F.when(F.col("corpus") != "lear", F.col("word")))
    with pytest.raises(RuntimeError, match="stg_words: non_null"):
        corpus.run(holes)
    assert corpus.run(holes, strict=False).report.filter("violations > 0").count() == 1


# --- federated revenue ---------------------------------------------------------------


def test_region_revenue(spark):
    amounts = [(1, "NW", "10.25"), (2, "NW", "0.50"), (3, "IS", "99.99"), (4, "HL", "5.00"),
               (5, "HL", "5.01"), (6, "HL", "5.02"), (7, "??", "7.00")]
    orders = spark.createDataFrame(
        [(i, c, decimal.Decimal(a)) for i, c, a in amounts],
        "order_id bigint, region_code string, amount decimal(10,2)")
    targets = spark.createDataFrame(
        [("NW", "Northern Woods", decimal.Decimal(11)), ("IS", "Islands", decimal.Decimal(50)),
         ("HL", "Highlands", decimal.Decimal(15))],
        "region_code string, region_name string, revenue_target decimal(38,9)")
    result = revenue.region_revenue(orders, targets)
    assert [(r.region_name, r.order_count, float(r.revenue), r.status) for r in result.collect()] == [
        ("Islands", 1, 99.99, "met"), ("Highlands", 3, 15.03, "met"), ("Northern Woods", 2, 10.75, "below")]
    assert all(r.ok for r in revenue.verify(result, 3, 6, 125.77).collect())


# --- governed views -------------------------------------------------------------------


def test_column_policy(spark):
    row = (1, "Rika", "Oduya", None, "1 St", "London", None, "UK", "N1", "123", None, "a@b.c", 3)
    frame = spark.createDataFrame([row], governed_files.CUSTOMER_SCHEMA)
    denied = governed_files.customers(frame)
    with pytest.raises(AccessDenied, match="phone"):
        denied.select("customer_id", "phone")
    with pytest.raises(AccessDenied):
        denied.select("*")
    assert denied.select("customer_id", "email").first().email == "a@b.c"
    assert denied.open().count() == 1 and "address" not in denied.open().columns
    masked = governed_files.customers(frame, mode="mask").select("*").first()
    assert masked.phone is None and masked.city == "London"
    granted = governed_files.customers(frame, [governed_files.SENSITIVE]).select("*").first()
    assert granted.phone == "123"
    with pytest.raises(ValueError):
        GovernedView(frame, {}, mode="odd")


def test_point_lookup_binds_its_parameter(spark):
    frame = spark.createDataFrame([(1, datetime.date(2026, 1, 1)), (2, None)], "id int, d date")
    sql = "SELECT * FROM {t} WHERE id = :id LIMIT 1"
    assert spark.sql(sql, args={"id": 2}, t=frame).first().id == 2
