"""The set join, the centroids and the prefix trie against brute force, and their defined edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sourcefold.llm import centroids, prefixes, setjoin

from .brute import brute_classes
from .test_operators import EDGE, WORDS, frame, texts

# 11 set join


def brute_links(docs, size, percent):
    def runs(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()

    own = [runs(t) for _, t in docs]
    out = Counter({k: 0 for k, _ in docs})
    for i, a in enumerate(own):
        for j in range(i):
            b = own[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                out[docs[i][0]] += 1
                out[docs[j][0]] += 1
    return out


def family(rng, n, size, edits, words=4000):
    """n copies of one text, with up to `edits` words changed each."""
    base = [f"w{rng.randrange(words)}" for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(size)] = f"x{rng.randrange(words)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("group", [256, 7])
def test_set_join_is_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(setjoin, "GROUP", group)
    rng = random.Random(group)
    own = family(rng, 110, 120, 5) + family(rng, 40, 30, 2) + family(rng, 30, 300, 20) + texts(60, 9, 4, WORDS[:3]) + texts(40, 60, 5)
    own += [t + " the same long tail that all of these have in common over and over again for good" for t in texts(80, 25, 6)]
    own += rng.choices(own, k=40)
    docs = list(enumerate(own))
    rng.shuffle(docs)
    found = {r.doc_id: r for r in setjoin.joined_sets(frame(spark, docs)).collect()}
    classes, links = brute_classes(docs, 5, 80), brute_links(docs, 5, 80)
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == {k: v[:2] for k, v in classes.items()}
    assert {k: r.n_links for k, r in found.items()} == dict(links)


def test_set_join_at_other_thresholds(spark):
    rng = random.Random(9)
    docs = list(enumerate(family(rng, 60, 60, 8) + texts(60, 12, 7, WORDS[:4])))
    for words, percent in ((1, 50), (3, 95), (2, 100)):
        found = setjoin.joined_sets(frame(spark, docs), words=words, threshold=percent).collect()
        links, classes = brute_links(docs, words, percent), brute_classes(docs, words, percent)
        assert {r.doc_id: (r.component_id, r.n_links) for r in found} == {k: (classes[k][1], links[k]) for k, _ in docs}


def test_set_join_takes_edges(spark):
    rows = [(i, t, "x") for i, t in [*EDGE, (6, "same text"), (9, "one two three four five six"), (9, "seven eight nine ten eleven twelve"), (10, "one two three four five six")]]
    found = [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in setjoin.joined_sets(frame(spark, rows, "doc_id long, text string, Component_Id string")).collect()]
    assert len(found) == len(rows)
    assert sorted(x for x in found if x[0] in (6, 7)) == [(6, 1, 6, 2), (6, 1, 6, 2), (7, 1, 6, 2)]
    assert sorted(x for x in found if x[0] in (9, 10)) == [(9, 2, 9, 0), (9, 2, 9, 1), (10, 2, 9, 1)]
    assert (None, 1, None, 0) in found and {(1, 0, 1, 0), (2, 0, 2, 0), (3, 0, 3, 0), (5, 1, 5, 0)} <= set(found)
    assert setjoin.joined_sets(frame(spark, [])).count() == 0


def test_answers_of_a_block_are_those_of_its_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        base = rng.choice(400, 120, replace=False)
        some = [np.unique(np.concatenate((rng.permutation(base)[: 120 - rng.integers(0, 20)], rng.integers(0, 400, rng.integers(0, 20))))).astype(np.uint64) for _ in range(25)]
        a, b = some[:12], some[12:]
        want = [[100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y)) for y in b] for x in a]
        assert (setjoin.compared(a, b, 80) == np.array(want)).all()


# 12 centroids


def brute_centroids(rows, dims, k, rounds):
    kept = [(i, np.array([int(np.floor(256 * float(x))) for x in v], object)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    own = [v for _, v in sorted(kept, key=lambda x: hashlib.sha256(f"2:{x[0]}".encode()).hexdigest())[:k]]
    near = lambda v: min((int(((v - c) ** 2).sum()), j) for j, c in enumerate(own))
    for _ in range(rounds):
        group = defaultdict(list)
        for _, v in kept:
            group[near(v)[1]].append(v)
        own = [sum(group[j]) // len(group[j]) if group[j] else own[j] for j in range(len(own))]
    out = [(i, *near(v)) for i, v in kept]
    sums = Counter()
    for _, d, j in out:
        sums[j] += d
    return {i: (j, d, sums[j], sum(sums.values()), hashlib.sha256(",".join(map(str, own[j])).encode()).hexdigest()) for i, d, j in out}


@pytest.mark.parametrize("dims,k", [(24, 9), (64, 40), (3, 500)])
def test_centroids_are_brute_force(spark, dims, k):
    rng = np.random.default_rng(dims)
    middle = rng.normal(size=(7, dims))
    rows = [(i, [float(x) for x in middle[i % 7] + 0.2 * rng.normal(size=dims)]) for i in range(250)]
    rows += [(300 + i, rows[3][1]) for i in range(40)]  # equal vectors
    rows += [(500, None), (501, []), (502, [1.0] * (dims - 1)), (503, [float("nan")] * dims), (504, [None] + [0.0] * (dims - 1)), (505, [float("inf")] * dims), (506, [-0.001] * dims)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, Cluster string").repartition(3)
    found = centroids.clustered(table, dims=dims, k=k).collect()
    assert {r.vec_id: (r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found} == brute_centroids(rows, dims, k, 5)


def test_centroids_take_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert centroids.clustered(spark.createDataFrame([], schema), dims=2).count() == 0
    assert centroids.clustered(spark.createDataFrame([(1, None), (2, [1e38, 0.0])], schema), dims=2).count() == 0
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [1.0, 1.0]), (2, [1.0, 1.0])]
    found = centroids.clustered(spark.createDataFrame(rows, schema), dims=2, k=40).collect()
    assert len(found) == 4 and {r.inertia for r in found} == {0} and found[0].centroid_sha256


def test_bounds_never_hide_the_nearest():
    rng = np.random.default_rng(5)
    x, c = rng.integers(-200, 200, (400, 64)), rng.integers(-200, 200, (40, 64))
    x[:40], c[7] = c, c[3]
    turn = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    model = centroids.Model(c, np.zeros(64), turn)
    y = x @ turn
    found, distance = centroids.nearest(x, y[:, :16], np.sqrt((y[:, 16:] ** 2).sum(1)), c, model.lead, model.rest)
    every = ((x[:, None] - c) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and (distance == every.min(1)).all()


# 13 prefix trie


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    conv = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        conv[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in conv.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        end = ",".join(map(str, sorted(c for c in m if len(conv[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children), len(leaves), saved, hashlib.sha256(end.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("most", [200_000, 30, 1])
def test_trie_is_brute_force(spark, most):
    rng = random.Random(3)
    rows = [(c, t if t != 1 or c % 7 else None, rng.choice(["user", None, "assistant"]), rng.choice(["a", "bé", None, "c" * 9])) for c in range(120) for t in range(rng.choice([1, 2, 3, 12]))]
    rows += [(c, t, "user", f"line {t}") for c in range(200, 230) for t in range(20)]  # one hot beginning
    rows += [(None, 1, "user", "x")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, Depth int").repartition(5)
    found = prefixes.trie(prefixes.rebuilt(prefixes.turns_of(table)), most=most).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_trie(rows)


def test_trie_takes_edges(spark, monkeypatch):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert prefixes.trie(prefixes.rebuilt(prefixes.turns_of(empty))).count() == 0
    monkeypatch.setattr(prefixes, "PIECE", 3)
    rows = [(5 * k, 0, "user", "x" * 100_000) for k in range(20)] + [(5 * k, 0, "user", "x" * 100_000) for k in range(3)]
    found = prefixes.trie(prefixes.rebuilt(prefixes.turns_of(spark.createDataFrame(rows, schema).repartition(4)))).collect()
    want = hashlib.sha256(",".join(str(5 * k) for k in range(3, 20)).encode()).hexdigest()
    assert [r.ends_sha256 for r in found if r.depth == 1 and r.n_convs == 20] == [want]
    assert max(r.n_convs for r in found) == 20 and {r.depth for r in found} == {0, 1, 2}


def test_pieces_of_ids_give_the_digest_of_all(spark):
    rows = spark.range(20_000).select(F.col("id").alias("conv_id"), F.encode(F.when(F.col("id") % 3 == 0, "a").otherwise("b"), "utf-8").alias("key")).repartition(7)
    found = {bytes(r.key): r.ends_sha256 for r in prefixes.ends(rows).collect()}
    for k, name in ((True, b"a"), (False, b"b")):
        assert found[name] == hashlib.sha256(",".join(str(i) for i in range(20_000) if (i % 3 == 0) is k).encode()).hexdigest()
