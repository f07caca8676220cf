"""Search, resampling and the vector index against brute force, with every odd case."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stratiform.llm import importance, lexical, pivots
from stratiform.llm.common import numbered
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, rank int, item long, n long, buckets string"
ITEMS = "item_id long, text string, doc_id string, score int"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return TERM.findall(lowered(text))


def prose(seed, n, size=400):
    rng = np.random.default_rng(seed)
    vocabulary = ["".join(np.random.default_rng(i).choice(list("abcdeghinorst"), 2 + i % 7)) + str(i % 3) for i in range(size)]
    return " ".join(vocabulary[int(x)] for x in rng.zipf(1.3, n) % size)


@pytest.fixture(scope="module")
def rows():
    base = prose(1, 300)
    texts = [
        None, "", " \n\t", "!?", "Seldom", "seldom SELDOM ÉTÉ été", base, base, base, base.upper(), prose(2, 20_000),
        "中文 한국 x" * 30, "z" * 5000, *(prose(i, 30 + 7 * i) for i in range(3, 60)),
    ]
    out = [(i * 7 % 101, t) for i, t in enumerate(texts)]
    out += [(None, base), (None, prose(5, 40)), (11, base), (11, base), (12, prose(6, 70))]
    return [(d, t, 1, 2, 3, "x") for d, t in out]


@pytest.fixture(scope="module")
def items():
    texts = [prose(7, 40), prose(8, 12), prose(7, 40), None, "", "unheard", "SELDOM été", "中文", prose(9, 200)]
    return [(i // 2 if i != 3 else None, t, "x", 0) for i, t in enumerate(texts)]


def ranked(rows, items, k=10):
    counts = [(d, Counter(words(t))) for d, t, *_ in rows]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    total, docs = sum(n for _, _, n in counts), len(counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text, *_ in items:
        scores = []
        for d, c, n in counts:
            m = 10 + (90 * n * docs) // total
            s = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(words(text)) if c[t])
            if s > 0:
                scores.append((-s, d is None, d, s))
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


@pytest.mark.parametrize("docs_in_tree", [lexical.TREE_DOCS, 40])
def test_search(spark, rows, items, monkeypatch, docs_in_tree):
    monkeypatch.setattr(lexical, "TREE_DOCS", docs_in_tree)
    docs = spark.createDataFrame(rows, DOCS).repartition(2)
    got = lexical.search(docs, spark.createDataFrame(items, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = ranked(rows, items)
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 30


def test_search_in_blocks_of_items(spark, rows, items, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 400)
    got = lexical.search(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS), lexical.Ranking(k=3))
    assert Counter(tuple(r) for r in got.collect()) == ranked(rows, items, 3)


def test_search_of_nothing(spark, rows, items):
    docs, queries = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    assert lexical.search(docs.limit(0), queries).count() == 0
    assert lexical.search(docs, queries.limit(0)).count() == 0


def test_trees_bound_every_document():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 40, 700)
    sizes[:200] = sizes[0]
    term = np.concatenate([rng.choice(90, n, replace=False) for n in sizes])
    value = rng.integers(1, 1_000_000, len(term))
    term[: 200 * sizes[0]] = np.tile(term[: sizes[0]], 200)
    value[: 200 * sizes[0]] = np.tile(value[: sizes[0]], 200)
    tree = lexical.BallTree(np.concatenate([[0], np.cumsum(sizes)]), term, value, 90)
    dense = np.zeros((700, 90), np.int64)
    dense[np.repeat(np.arange(700), sizes), term] = value
    assert sorted(tree.order) == list(range(700))
    q = rng.integers(0, 20_000, 90)
    todo, leaves = [tree.root], 0
    while todo:
        ball = todo.pop()
        bound = q[ball.terms] @ ball.values + np.sqrt((q * q).sum()) * ball.radius
        assert (dense[tree.order[ball.first : ball.last]] @ q).max() <= bound * (1 + lexical.SLACK)
        todo += ball.halves or []
        leaves += ball.halves is None
    assert leaves >= 700 // lexical.LEAF_DOCS


def test_trees_prune():
    # Two far groups: the search for one never opens the other's leaves.
    rng = np.random.default_rng(5)
    term = np.concatenate([np.arange(10) + 10 * (i % 2) for i in range(2000)])
    value = 900_000 + rng.integers(0, 100, len(term))
    tree = lexical.BallTree(np.arange(0, 20_001, 10), term, value, 20)
    opened = []
    entries = tree.entries
    tree.entries = lambda docs: opened.append(docs) or entries(docs)
    weights = np.zeros((1, 20), np.int64)
    weights[0, :10] = 1000
    tops = [[]]
    lexical.search_tree(tree, list(range(2000)), weights, np.sqrt((weights.astype(float) ** 2).sum(1)), tops, 5)
    assert sum(map(len, opened)) <= 1000 and all(d % 2 == 0 for docs in opened for d in docs)
    scores = value.reshape(-1, 10)[::2].sum(1) * 1000
    assert sorted(x[0] for x in tops[0]) == sorted(scores)[-5:]


def features_of(text, longest):
    w = words(text)
    return [" ".join(w[i : i + k]).encode() for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("longest, head", [(1, 20_000), (2, 50), (3, 7)])
def test_resampling(spark, rows, items, longest, head):
    f = importance.Features(words=longest, head=head)
    got = importance.resample(spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), f, percent=30).collect()
    s, t = Counter(), Counter()
    for _, text, *_ in rows:
        s.update(zlib.crc32(x) % 10_000 for x in features_of(text, longest))
    for _, text, *_ in items:
        t.update(zlib.crc32(x) % 10_000 for x in features_of(text, longest))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (big_s + 10_000.0) / ((s[b] + 1.0) * (big_t + 10_000.0)))) for b in s}
    want, competing = [], []
    for d, text, *_ in rows:
        own = features_of(text, longest)
        w = sum(gain[zlib.crc32(x) % 10_000] for x in own)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append((d, len(own), w, score))
        if len(words(text)) >= 20:
            competing.append((-score, d is None, d or 0))
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(want)
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, len(competing) * 30 // 100 + 1))
    assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in drawn] == sorted(competing)[: len(drawn)]


def test_resampling_of_nothing(spark, rows, items):
    docs, target = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    assert importance.resample(docs.limit(0), target).count() == 0
    assert importance.resample(docs, target.limit(0)).count() == len(rows)


def test_the_head_holds_what_is_frequent(spark):
    texts = [(" ".join([f"often{j}" for j in range(20)] + [f"rare{i}x{j}" for j in range(20)]),) for i in range(400)]
    f = importance.Features(words=2, head=100)
    head = importance.head_vocabulary(spark.createDataFrame(texts, "text string").repartition(4), f)
    assert set(head.states) == {f"often{j}".encode() for j in range(20)}
    assert (b"often0", b"often1") in head.pairs and len(head.pairs) <= 100
    summary = importance._Frequent(10)
    for i in range(1000):
        summary.add([b"hot", b"warm", str(i).encode()])
    assert {x for x, _ in summary.rows(10)} == {b"hot", b"warm"} and len(summary.counts) <= 41


def test_numbering_by_ranges(spark):
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("a"), F.col("id").alias("b"))
    got = sorted(numbered(rows, [F.col("a").desc(), F.col("b")], "nth").collect(), key=lambda r: r.nth)
    assert [r.nth for r in got] == list(range(1, 5001))
    assert [(-r.a, r.b) for r in got] == sorted((-r.a, r.b) for r in got)


def linked_by_force(vectors, least=0.95):
    """Links and smallest reachable id of every row."""
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    width = max([len(v) for _, v in vectors if good(v)], default=0)
    x = np.zeros((len(vectors), width))
    for i, (_, v) in enumerate(vectors):
        if good(v):
            own = np.array(v) / max(map(abs, v))
            x[i, : len(v)] = own / np.linalg.norm(own)
    near = x @ x.T >= least
    label = np.arange(len(x))
    for _ in range(len(x)):
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    out = []
    for i, (d, v) in enumerate(vectors):
        ids = [vectors[j][0] for j in np.flatnonzero(label == label[i]) if vectors[j][0] is not None]
        least_id = min(ids) if ids else None
        out.append((d, int(near[i].sum()) - int(near[i, i]), least_id, d == least_id))
    return Counter(out)


def clouds(seed, n, width):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    out = [list(map(float, rng.normal(size=width))) for _ in range(n)]
    for i in range(n):
        out.append([float(x) for x in centres[i % 12] + rng.normal(size=width) * (0.05 + 0.02 * (i % 12))])
    return out


@pytest.mark.parametrize("kind, block", [("double", 2048), ("float", 37)])
def test_vectors(spark, kind, block):
    own = clouds(1, 300, 24)
    if kind == "float":
        own = [[float(np.float32(x)) for x in v] for v in own]
    odd = [
        None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [1.0], [2.0, 0.0], [-0.0, 1.0], [0.0, 3.0],
        [1e30] * 24, [1e-30] * 24, [-1.0] * 24,
    ]
    vectors = [((i * 31) % 977, v) for i, v in enumerate(own + own[:40] + [own[5]] * 60 + odd)]
    vectors += [(None, own[7]), (None, own[7]), (None, odd[2]), (3, own[9]), (3, own[9])]
    rows = [(d, v, 7, "x", 1) for d, v in vectors]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n int, cls string, v int").repartition(5)
    got = pivots.near_vectors(frame, pivots.PivotIndex(block=block))
    want = linked_by_force(vectors)
    assert Counter((r.vec_id, r.n_links, r.component_id, bool(r.vec_id == r.component_id)) for r in got.collect()) == want


def test_vectors_without_any(spark):
    schema = "vec_id long, embedding array<float>"
    assert pivots.near_vectors(spark.createDataFrame([], schema)).count() == 0
    got = pivots.near_vectors(spark.createDataFrame([(1, None), (None, [0.0])], schema)).collect()
    assert {tuple(r) for r in got} == {(1, 0, 1, True), (None, 0, None, True)}


def test_recall_of_the_index(spark):
    """Against brute force, with links at all cosines from 0.95 on."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(1500, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1, keepdims=True) * base
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = rng.uniform(0.951, 0.999, (1500, 1))
    both = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * away])
    vectors = [(i, list(map(float, v))) for i, v in enumerate(both)]
    want = sum(n * times for (_, n, _, _), times in linked_by_force(vectors).items())
    got = pivots.near_vectors(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))
    assert got.agg(F.sum("n_links")).first()[0] >= 0.99 * want
