import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioline.functions import text as T
from folioline.operators import search as S
from folioline.operators.nearest import knn_cosine
from folioline.operators.ranking import top_k


def brute_bm25(pages, queries, k):
    tokens = {i: t.split() for i, t in pages}
    n, avg = len(tokens), sum(map(len, tokens.values())) / len(tokens)
    out = {}
    for query, terms in queries.items():
        scores = []
        for i, words in tokens.items():
            score = 0.0
            for term in set(terms):
                df = sum(term in w for w in tokens.values())
                tf = words.count(term)
                score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg))
            if score > 0:
                scores.append((-round(score, 9), i))
        out[query] = [(i, round(-s, 6)) for s, i in sorted(scores)[:k]]
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(150)]
    texts += [texts[0]] * 60 + ["", " \n"]  # many copies of one text, and texts without tokens
    return list(enumerate(texts))


QUERIES = {"a": ["w1", "w2", "w2"], "b": ["w3"], "c": ["nowhere", "w5", "w6"], "d": ["nowhere"]}


@pytest.mark.parametrize("limits", [{}, {"inline_terms": 1}, {"inline_terms": 1, "broadcast_pairs": 2}])
@pytest.mark.parametrize("as_frame", [False, True])
def test_bm25(spark, corpus, limits, as_frame):
    pages = spark.createDataFrame(corpus, "id long, text string").repartition(5)
    queries = QUERIES
    if as_frame:
        queries = spark.createDataFrame([(q, t) for q, terms in QUERIES.items() for t in terms], "query_id string, term string")
    elif "broadcast_pairs" in limits:
        limits = {**limits, "broadcast_pairs": 3}
    found = {}
    for r in sorted(S.bm25_topk(pages, queries, 12, **limits).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["id"], round(r["score"], 6)))
    expected = {q: v for q, v in brute_bm25(corpus, QUERIES, 12).items() if v}
    assert found == expected


def test_bm25_without_terms(spark, corpus):
    with pytest.raises(ValueError):
        S.bm25_topk(spark.createDataFrame(corpus, "id long, text string"), {}, 3)


def brute_knn(pages, queries, k, exclude_self=False):
    out = {}
    for q, v in queries:
        if v is None or not np.any(v):
            continue
        sims = []
        for i, e in pages:
            if e is None or not np.any(e) or (exclude_self and i == q):
                continue
            a, b = np.array(e, dtype=np.float64), np.array(v, dtype=np.float64)
            sims.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9), i))
        out[q] = [i for _, i in sorted(sims)[:k]]
    return out


def vectors(n, names):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(n, 8)).astype(np.float32)
    data[n // 3: 2 * n // 3] = data[0]  # a third of the pages are copies
    rows = [(names(i), [float(x) for x in v]) for i, v in enumerate(data)]
    return rows + [(names(n), None), (names(n + 1), [0.0] * 8)]


@pytest.mark.parametrize("method, limits", [
    ("auto", {}), ("blocks", {"broadcast_queries": 7, "block_rows": 50}), ("auto", {"broadcast_queries": 3, "block_rows": 1000})])
@pytest.mark.parametrize("names, kind", [(lambda i: i, "long"), (lambda i: f"p{i}", "string")])
def test_knn(spark, method, limits, names, kind):
    rows = vectors(300, names)
    pages = spark.createDataFrame(rows, f"id {kind}, embeddings array<float>").repartition(5)
    queries = rows[:6] + rows[150:152] + rows[-2:]
    frame = spark.createDataFrame(queries, f"query_id {kind}, vector array<float>")
    for exclude_self in (False, True):
        found = {}
        result = knn_cosine(pages, frame, 5, method=method, exclude_self=exclude_self, **limits).collect()
        for r in sorted(result, key=lambda r: (str(r["query_id"]), r["rank"])):
            found.setdefault(r["query_id"], []).append(r["id"])
        assert found == brute_knn(rows, queries, 5, exclude_self)


def test_knn_more_than_there_are(spark):
    rows = vectors(3, lambda i: i)
    pages = spark.createDataFrame(rows, "id long, embeddings array<float>")
    queries = spark.createDataFrame(rows[:1], "query_id long, vector array<float>")
    assert knn_cosine(pages, queries, 50).count() == 3
    assert knn_cosine(pages, queries.limit(0), 5).count() == 0
    assert knn_cosine(pages.limit(0), queries, 5).count() == 0
    with pytest.raises(ValueError):
        knn_cosine(pages, queries, 5, method="broadcast", broadcast_queries=0)


def test_top_k_prunes_before_the_shuffle(spark):
    from tests.conftest import plan_of
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.rand(1).alias("s"), "id")
    assert plan_of(top_k(df, "g", "s", "id", 2)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("text, expected", [
    ("der die der", "<b>der</b> <b>die</b> <b>der</b>"),
    ("  der\n\tdie,  Der under", "  <b>der</b>\n\tdie,  Der under"),
    ("c++ a.c abc", "<b>c++</b> <b>a.c</b> abc"),
    ("derdie der", "derdie <b>der</b>"),
    ("", "")])
def test_highlight(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(T.highlight(F.col("t"), ["der", "die", "c++", "a.c"])).first()[0] == expected
    assert df.select(T.highlight(F.col("t"), [])).first()[0] == text


def test_stems(spark, rows):
    docs = spark.createDataFrame([(1, "Haus Häuser  Hund"), (2, "Häuser")], "id int, text string")
    stems = S.build_stem_map(docs, F.substring("token", 1, 1))
    assert rows(stems) == [("Haus", "H"), ("Hund", "H"), ("Häuser", "H")]
    known = stems.where("token like '%us%'")
    assert rows(S.analyze_tokens(docs, ["id"], stem_map=known)) == [(1, "H"), (1, "H"), (1, "Hund"), (2, "H")]
    assert rows(S.expand_terms(["Haus", "x"], known)) == [("Haus",), ("Häuser",), ("x",)]


def test_stats(spark, rows):
    docs = spark.createDataFrame([("a a b",), ("b",), ("",)], "text string")
    assert rows(S.term_stats(docs)) == [("a", 1), ("b", 2)]
    assert rows(S.length_stats(docs)) == [(3, 4, 4 / 3)]


def _shuffled_rows(node) -> int:
    """Rows written by all shuffles below a plan that has run."""
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return _shuffled_rows(node.executedPlan())
    if name.endswith("QueryStage"):
        return _shuffled_rows(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return own + sum(_shuffled_rows(node.children().apply(i)) for i in range(node.children().size()))


def test_blocks_shuffle_each_page_once(spark):
    """However many blocks of queries there are, a page travels once, and a word once per task for the document frequencies."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(50)]
    corpus = [(i, " ".join(rng.choices(words, k=20))) for i in range(2000)]
    queries = {f"q{i}": rng.sample(words, 3) for i in range(40)}
    asked = spark.createDataFrame([(q, t) for q, terms in queries.items() for t in terms], "query_id string, term string")
    pages = spark.createDataFrame(corpus, "id long, text string").repartition(4)
    best = S.bm25_topk(pages, asked, 2, inline_terms=0, broadcast_pairs=0, query_rows=2, page_rows=500)
    found, expected = (sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 6)) for r in df.collect())
                       for df in (best, S.bm25_topk(pages, asked, 2, inline_terms=0)))
    assert found == expected and len(found) == 80
    # 2,000 by the test's own repartition, 2,000 pages, 160 copies of queries, terms, best rows; 20 copies of the pages are 40,000
    assert _shuffled_rows(best._jdf.queryExecution().executedPlan()) < 5 * len(corpus)
