"""Each operator against a brute-force version, and its defined edge cases."""

import math
import os
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sourcefold.llm import bpe, chat, decontamination, licences, neardup, private, quality, shuffling, substrings, tokenfiles
from sourcefold.llm.common import Memo, join_counted, shared_dir

from .brute import brute_classes, brute_counts, brute_hits, brute_removed, brute_spans

WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa".split()


def texts(n, size, seed=0, words=WORDS):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, size))) for _ in range(n)]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "word " * 30_000), (None, "no id here"), (6, "same text"), (7, "same text")]


# 1 benchmark decontamination


def test_decontamination_is_brute_force(spark):
    items = [(k, t) for k, t in enumerate(texts(12, 20, 1, WORDS[:3]))] + [(50, "ALPHA, beta!"), (51, None), (52, "..."), (None, "gamma"), (50, "alpha beta")]
    docs = list(enumerate(texts(60, 60, 2, WORDS[:4]))) + [(100, None), (101, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wanted = {i: brute_hits(t, [x for x in items if x[0] is not None]) for i, t in docs}
    for blocks in (10**9, 60):
        found = decontamination.decontaminate(frame(spark, docs), bench, block_bytes=blocks).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == wanted
    assert all(r.contaminated == (wanted[r.doc_id][1] > 0 and 20 * wanted[r.doc_id][1] >= wanted[r.doc_id][0]) for r in found)


def test_decontamination_cuts_spans_and_takes_edges(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox")], "item_id long, text string")
    rows = [(1, "I saw The quick, brown FOX jump.", "x"), *((i, t, "x") for i, t in EDGE)]
    found = {r.doc_id: r for r in decontamination.decontaminate(frame(spark, rows, "doc_id long, text string, N_hit string"), bench).where("n_hit > 0").collect()}
    assert list(found) == [1] and found[1].clean_text == "I saw  jump."
    assert decontamination.decontaminate(frame(spark, rows, "doc_id long, text string, kept string"), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.decontaminate(frame(spark, []), bench).count() == 0


# 2 substring dedup


def test_substrings_are_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 90))) for _ in range(6)]
    docs = [(k, "\n".join([*(rng.choice(passages) for _ in range(rng.randint(0, 2))), " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))])) for k in range(80)]
    docs += [(200, None), (201, ""), (202, "a " * 200), (203, passages[0]), (204, passages[0])]
    for window, first in ((35, 9), (35, 18), (7, 2)):
        found = substrings.deduplicate(frame(spark, docs), window=window, first=first).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_removed(docs, window)


def test_substrings_take_edges(spark):
    rows = [(i, t, 7) for i, t in [*EDGE, (8, "x y z " * 20), (8, "x y z " * 20)]]
    found = substrings.deduplicate(frame(spark, rows, "doc_id long, text string, N_Words int"))
    assert found.count() == len(rows) and "N_Words" not in found.columns
    assert {r.n_removed for r in found.where("doc_id = 8").collect()} == {60}
    assert substrings.deduplicate(frame(spark, [])).count() == 0
    assert substrings.lengths(35, 9) == [9, 18, 35]


def shuffled(spark, run) -> int:
    """Bytes that all stages of run() write to shuffles."""
    sc = spark.sparkContext
    store = sc._jsc.sc().statusStore()
    stages = lambda: store.stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    every = lambda: {(x.stageId(), x.attemptId()): x.shuffleWriteBytes() for x in (found.apply(k) for found in [stages()] for k in range(found.size()))}
    before = every()
    run()
    time.sleep(1)  # the store hears of finished stages a little later
    return sum(n for k, n in every().items() if k not in before)


def test_substrings_shuffle_few_bytes_a_place(spark):
    # keys beside the columns they were made of, and a hash of the text with every place, made it 20.4 bytes a word here; 17.0 without
    rng = random.Random(12)
    docs = [(k, " ".join(str(rng.randrange(9)) for _ in range(1500))) for k in range(60)]
    docs += [(100 + k, t) for k, t in docs]
    found = []
    sent = shuffled(spark, lambda: found.extend(substrings.deduplicate(frame(spark, docs).repartition(6, "doc_id"), texts=False).collect()))
    assert all(r.n_removed == 1500 for r in found) and len(found) == 120
    assert sent < 18.5 * 180_000


def test_substrings_tell_rows_of_one_id_apart(spark, monkeypatch):
    rng = random.Random(13)
    passage = lambda: " ".join(f"w{rng.randrange(500)}" for _ in range(60))
    shared = [passage() for _ in range(8)]
    docs = [(i, f"{passage()} {rng.choice(shared)}" if rng.random() < 0.6 else passage()) for i in [1, 2, 3, 4, 4, 4, 5, 5, 6, None, None, None, 7, 8]] + [(6, None), (9, ""), (9, shared[0])]
    wanted = brute_removed(list(enumerate(t for _, t in docs)), 35)
    wanted = Counter((i, *wanted[k]) for k, (i, _) in enumerate(docs))
    one = [(k, t) for k, (_, t) in enumerate(docs)]
    for most in (200_000, 1):
        monkeypatch.setattr(substrings, "BROADCAST_ROWS", most)
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.deduplicate(frame(spark, docs)).collect()) == wanted
        told = lambda rows: [(r.doc_id, r.m) for d, m in [substrings.marks(frame(spark, rows), "doc_id", "text")] for r in d.select("doc_id", m.alias("m")).collect()]
        assert {m for _, m in told(one)} == {0}
        assert all((m != 0) == (i in (4, 5, 6, 9, None) or most == 1) for i, m in told(docs)) and len(told(docs)) == len(docs)


# 3 personal data


def test_base_spans_are_brute_force(spark):
    rng = random.Random(3)
    pool = ["@", ".", "-", " ", "+", "1", "23", "255", "4111111111111111", "a", "b@c.de", "x_", "%", "é", "🙂", "(", ")", "1.2.3.4", "+1 234 567 8901", "\n", "0"]
    docs = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(3000)] + [(5000, None), (5001, ""), (5002, "1" * 30000), (5003, "a" * 50000), (5004, "1 " * 20000)]
    found = private.with_base(frame(spark, docs), "text").select("doc_id", private.written("_base", private.KINDS).alias("b")).collect()
    texts_by_id = dict(docs)
    assert all(r.b == brute_spans(texts_by_id[r.doc_id]) for r in found) and len(found) == len(docs)


def test_terms_that_disclose_an_entity_go(spark):
    rng = random.Random(1)
    filler = lambda: " ".join(rng.choice(WORDS) for _ in range(20))
    docs = [(k, f"{filler()}. Zorblax {rng.choice(WORDS)} at zor@example.org {filler()}") for k in range(6)] + [(100 + k, filler()) for k in range(50)]
    docs += [(200 + k, "copied Unseenword by copy@example.org") for k in range(9)]
    found = {r.doc_id: r for r in private.sanitise(frame(spark, docs)).collect()}
    assert all("Zorblax" not in found[k].clean_text and "[EMAIL]" in found[k].clean_text for k in range(6))
    assert all(found[k].clean_text == t for k, t in docs if 100 <= k < 200)
    assert all("Unseenword" in found[200 + k].clean_text for k in range(9)), "one context, however often copied, discloses nothing"


def test_terms_disclose_wherever_they_stand(spark):
    rng = random.Random(2)
    filler = lambda: " ".join(rng.choice(WORDS) for _ in range(30))
    # far from the entity, twice; in one fixed block; beside an entity that isn't its own
    docs = [(k, f"Farlax {filler()}. Mail far@example.org {filler()} {filler()} farlax-é") for k in range(6)]
    docs += [(20 + k, f"{filler()}\nRegards, Blocklax\nblock@example.org") for k in range(6)]
    docs += [(40 + k, f"{filler()} Often {filler()} often@example.org") for k in range(4)] + [(60 + k, f"Often {filler()}") for k in range(40)]
    docs += [(200 + k, f"copied  Unseenword {'BY' if k % 2 else 'by'} copy@example.org") for k in range(9)] + [(300 + k, filler()) for k in range(60)]
    found = {r.doc_id: r for r in private.sanitise(frame(spark, docs)).collect()}
    for k, text in docs:
        want = re.sub(r"[a-z]+@example\.org", "[EMAIL]", text)
        if k < 40:
            want = want.replace("Farlax", "").replace("farlax-é", "").replace("Blocklax", "").replace("Regards", "")
        if k < 20:
            want = want.replace("Mail", "")
        assert found[k].clean_text == want, k


def test_levels_are_brute_force(spark):
    rng = random.Random(3)
    names = [f"{a}{b}" for a in "bcdfgh" for b in ("ana", "olo", "uru")]
    docs = []
    for k in range(200):
        who = rng.choice(names)
        text = " ".join([*rng.choices(WORDS, k=5), who if rng.random() < 0.9 else rng.choice(names), *rng.choices(WORDS, k=40), *([f"{who}@x.org"] if rng.random() < 0.9 else []), *(["all@x.org"] if rng.random() < 0.4 else [])])
        docs += [(len(docs) + c, text) for c in range(rng.choice([1, 1, 1, 4]))]
    n, held = len(docs), [(set(re.findall(r"\S+@x.org", t)), {w for w in t.split() if "@" not in w}, set(re.findall(r"\w+", t)), t) for _, t in docs]
    want = {}
    for e in {e for es, *_ in held for e in es}:
        for t in {t for _, ts, *_ in held for t in ts}:
            both = [x for es, ts, _, x in held if e in es and t in ts]
            if len(set(both)) >= 3:
                n_e, n_t = sum(e in es for es, *_ in held), sum(t in every for _, _, every, _ in held)
                level = math.log(n * len(both) / (n_t * n_e)) / math.log(n / n_e)
                if level >= 0.6:
                    want[e, t] = round(level, 9)
    table = frame(spark, docs)
    _, rows = private.examined(table, "doc_id", "text")
    found = private.disclosing(table, rows.cache(), "text", 0.6, 3).collect()
    assert {(r.entity, r.term): round(r.level, 9) for r in found} == want and want


def test_term_spans_are_brute_force(spark):
    rng = random.Random(8)
    names = ["Zorblax", "Quimby-o", "d'Arvo", "tessa"]
    filler = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    docs = []
    for k in range(120):
        who = k % 4
        parts = [filler(6), names[who] if k < 60 else "", filler(5), f"{'abcd'[who]}@x.org" if k < 60 or rng.random() < 0.1 else "", filler(3), names[who] * (rng.random() < 0.5 and k < 60)]
        docs.append((k, " ".join(parts)))
    held = {k: (set(re.findall(r"[a-d]@x\.org", t)), t) for k, t in docs}
    token = re.compile(r"(?<![@.\w])[^\W\d_](?:[^\W\d_]|['-])*(?![@\w])")
    words = {k: {m[0].lower() for m in token.finditer(re.sub(r"[a-d]@x\.org", lambda m: "\0" * len(m[0]), t))} for k, (_, t) in held.items()}
    n, level = len(docs), {}
    for e in "abcd":
        e += "@x.org"
        of = [k for k in held if e in held[k][0]]
        for t in set().union(*(words[k] for k in of)):
            both = sum(t in words[k] for k in of)
            if len({held[k][1] for k in of if t in words[k]}) >= 3:
                level[e, t] = math.log(n * both / (sum(t in w for w in words.values()) * len(of))) / math.log(n / len(of))
    want = {}
    for k, (es, text) in held.items():
        spans = [(m.start(), "email", m.end()) for m in re.finditer(r"[a-d]@x\.org", text)]
        for m in token.finditer(re.sub(r"[a-d]@x\.org", lambda m: "\0" * len(m[0]), text)):
            if any(level.get((e, m[0].lower()), 0) >= 0.9 for e in es):
                spans.append((m.start(), "term", m.end()))
        want[k] = ",".join(f"{kind}:{a}:{b}" for a, kind, b in sorted(spans))
    table = frame(spark, docs)
    base, terms = private.found_spans(table)
    rows = private.with_terms(base, terms).withColumn("every", private.every_span())
    found = {r.id: r.s for r in rows.select("id", private.written("every", [*private.KINDS, "term"]).alias("s")).collect()}
    assert found == want and sum(s.count("term") for s in want.values()) > 60


def test_many_spans_take_time_in_proportion(spark):
    began = time.time()
    rows = [(k, " ".join(f"10.{i % 256}.{k}.{i // 256} x{i}" for i in range(50_000))) for k in range(3)]
    found = private.sanitise(frame(spark, rows)).collect()
    for r in found:
        assert len(r.spans) == 50_000 and r.clean_text == " ".join(f"[IP] x{i}" for i in range(50_000))
    assert time.time() - began < 120


def test_copied_lists_take_time_in_proportion(spark):
    rng = random.Random(11)
    filler = [(100 + k, " ".join(rng.choices(WORDS, k=20))) for k in range(300)]
    began = time.time()
    letters = ["".join("abcdefghij"[int(d)] for d in str(i)) for i in range(5000)]
    rows = [(k, " ".join(f"10.{i % 256}.7.{i // 256} name-{w}" for i, w in enumerate(letters)) + f" day {WORDS[k]}") for k in range(3)]
    found = {r.doc_id: r for r in private.sanitise(frame(spark, rows + filler)).collect()}
    for k in range(3):
        assert [x.kind for x in found[k].spans].count(private.KINDS.index("ip")) == 5000 and sum(x.kind == len(private.KINDS) for x in found[k].spans) == 5001
        assert found[k].clean_text == " ".join(["[IP] "] * 5000) + f"  {WORDS[k]}"
    assert all(found[k].clean_text == t for k, t in filler)
    assert time.time() - began < 60


def test_private_takes_edges(spark):
    rows = [(i, t, "s") for i, t in [*EDGE, (9, "mail me@x.org"), (9, "mail me@x.org")]]
    found = private.sanitise(frame(spark, rows, "doc_id long, text string, Spans string"))
    assert found.count() == len(rows)
    assert [r.clean_text for r in found.where("doc_id = 9").collect()] == ["mail [EMAIL]"] * 2
    assert found.where("doc_id = 1").first().clean_text is None
    assert private.sanitise(frame(spark, [])).count() == 0


# 4 near duplicates


def test_near_duplicates_are_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for _ in range(6):
        base = [rng.choice(words) for _ in range(rng.randint(40, 150))]
        for _ in range(rng.choice([1, 3, 40])):
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append((len(docs), " ".join(copy)))
    docs += [(500, "Alpha beta"), (501, "alpha  BETA"), (502, None), (503, ""), (504, docs[0][1]), (505, docs[0][1])]
    for shingle, percent in ((3, 85), (5, 80)):
        found = neardup.near_duplicates(frame(spark, docs), shingle=shingle, threshold=percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_classes(docs, shingle, percent)


def test_near_duplicates_take_edges(spark):
    rows = [(i, t, 1) for i, t in [*EDGE, (6, "same text")]]
    found = neardup.near_duplicates(frame(spark, rows, "doc_id long, text string, component_id int"))
    assert found.count() == len(rows)
    assert {r.component_id for r in found.where("doc_id IN (6, 7)").collect()} == {6}
    assert found.where("doc_id IS NULL").first().kept
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    assert neardup.deduplicated(frame(spark, rows, "doc_id long, text string, kept int")).where("doc_id = 7").count() == 0


def test_rows_that_repeat_an_id_join_their_classes(spark):
    rng = random.Random(12)
    one, two = ([f"{x}{rng.randrange(10**6)}" for _ in range(60)] for x in "ab")
    near = lambda words: " ".join([*words[:-1], "else"])
    rows = [(5, " ".join(one)), (5, " ".join(two)), (6, near(one)), (7, near(two)), (8, "apart from all of these"), (5, " ".join(one))]
    found = {r.doc_id: (r.component_id, r.kept) for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert found == {5: (5, True), 6: (5, False), 7: (5, False), 8: (8, True)}
    left = neardup.deduplicated(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(5, min(rows)[1]), (8, rows[4][1])]


def test_a_stretched_group_is_settled_exactly(spark):
    # copies drift from one another step by step, from several starts that share most of their words
    rng = random.Random(13)
    base, docs = [f"w{i}" for i in range(100)], []
    for start in range(6):
        words = [w if rng.random() < 0.93 else f"s{start}_{i}" for i, w in enumerate(base)]
        for step in range(60):
            if rng.random() < 0.7:
                words = list(words)
                words[rng.randrange(100)] = f"x{start}_{step}"
            docs.append((len(docs), " ".join(words)))
    rng.shuffle(docs)
    found = neardup.near_duplicates(frame(spark, docs), shingle=3, threshold=85, hashes=60).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_classes(docs, 3, 85)
    # rare shingles and common ones in one bucket give all pairs of different components
    for often in (False, True):
        rows = [(k, k, 10, 10, [(0, 1, often), (1, 2, often)]) for k in range(4)]
        members = spark.createDataFrame(rows, "node long, comp long, n long, common long, prefix array<struct<place: long, s: long, often: boolean>>")
        buckets = spark.createDataFrame([(7, k) for k in range(4)], "key long, node long")
        assert {(r.a, r.b) for r in neardup.prefix_pairs(members, buckets, 85).collect()} == {(a, b) for a in range(4) for b in range(a + 1, 4)}


def test_frequent_keys_are_joined_like_others(spark, monkeypatch):
    monkeypatch.setattr("sourcefold.llm.common.BROADCAST_ROWS", 2)
    rows = spark.createDataFrame([(1, i) for i in range(3000)] + [(k, k) for k in range(2, 1500)], "k long, v long")
    keys = rows.groupBy("k").agg(F.count("*").alias("n")).where("k % 2 = 1")
    found = join_counted(rows, keys, ["k"], "n")
    assert sorted(map(tuple, found.collect())) == sorted((k, v, 3000 if k == 1 else 1) for k, v in map(tuple, rows.collect()) if k % 2)


def test_memos_forget_by_generations():
    asked = []
    memo = Memo(lambda k: asked.append(k) or k * 2, 10)
    assert [memo[k] for k in [*range(10), *range(5), 10, 0, 1]] == [2 * k for k in [*range(10), *range(5), 10, 0, 1]] and len(asked) == 11
    assert [memo[k] for k in range(20, 60)] == [2 * k for k in range(20, 60)] and len(memo) + len(memo.older) <= 20


# 5 chat formatting


def test_reply_trees(spark):
    nasty = ["\\", "\\<|start|>", "<|end|>\n", "<\\|", "<<SYS>>x<</SYS>>", "[INST]\\[/INST]", "", "a\nb", "<s></s>", "<"]
    rows = [(1, 1, None, "u\nser", "q", 0.0), (1, 2, 1, "assistant", nasty[1], 1.0), (1, 3, 1, "assistant", nasty[2], 5.0), (1, 4, 3, "user", nasty[4], 0.0), (1, 5, 4, "assistant", nasty[5], 2.0)]
    rows += [(2, 1, 9, "user", None, None), (3, 1, 2, None, "x", 0.0), (3, 2, 1, "user", "y", 0.0), (3, 3, 2, "user", "z", 0.0)]
    rows += [(9, i, i - 1 if i else None, "assistant", nasty[i % 10], None) for i in range(70)]
    rows += [rows[0]]
    messages = spark.createDataFrame(rows, "tree int, node int, parent int, role string, text string, score double").repartition(3)
    found = chat.conversations(messages, top=2).withColumns({"turns": chat.read_back(F.col("conversation")), "learned": chat.under_mask(F.col("conversation"), F.col("loss"))}).collect()
    by = {(r.tree, r["rank"]): r for r in found}
    assert [tuple(t) for t in by[1, 1].turns] == [("u\nser", "q"), ("assistant", nasty[2]), ("user", nasty[4]), ("assistant", nasty[5])]
    assert by[1, 1].learned == nasty[2] + nasty[5] and by[1, 2].learned == nasty[1]
    assert [t.text for t in by[9, 1].turns] == [nasty[i % 10] for i in range(70)]
    assert [tuple(t) for t in by[2, 1].turns] == [("user", "")] and not any(t == 3 for t, _ in by), "a cycle has no root"
    assert all("<|" not in re.sub(r"<\|start\|>|<\|end\|>", "", r.conversation) for r in found)
    assert chat.conversations(messages.limit(0)).count() == 0


@pytest.mark.parametrize("top", [1, 3])
def test_random_forests_are_brute_force(spark, top):
    rng = random.Random(top)
    rows = []
    for tree in [None, *range(12)]:
        size = rng.choice([1, 2, 9, 40])
        near = rng.choice([1, 3, 40])
        for node in range(size):
            # a parent just before makes deep trees, any before it wide ones; some are missing, some close a cycle
            parent = None if node == 0 else rng.choice([rng.randint(max(0, node - near), node - 1)] * 12 + [None, 999, size - 1])
            rows.append((tree, node, parent, rng.choice(["user", "assistant"]), f"t{tree}n{node}", rng.choice([None, 0.0, 0.5, 1.0, 4.0, float("nan")])))
    want = {}
    for tree in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == tree}
        branches = []
        for leaf in set(own) - {r[2] for r in own.values()}:
            path, at = [], leaf
            while at in own and at not in path:
                path.append(at)
                at = own[at][2]
            if at not in path:
                scores = [own[k][5] if own[k][5] and own[k][5] == own[k][5] else 0.0 for k in path]
                branches.append((-sum(scores) / len(path), -len(path), leaf, path[::-1]))
        for rank, (score, _, leaf, path) in enumerate(sorted(branches)[:top], 1):
            want[tree, rank] = (leaf, -score, [(own[k][3], own[k][4]) for k in path])
    messages = spark.createDataFrame(rng.sample(rows, len(rows)), "tree int, node int, parent int, role string, text string, score double").repartition(3)
    found = chat.conversations(messages, top=top).withColumn("turns", chat.read_back(F.col("conversation"))).collect()
    assert {(r.tree, r["rank"]): (r.leaf, r.score, [tuple(t) for t in r.turns]) for r in found} == want and len(found) == len(want)


def test_a_comb_costs_rows_for_its_messages(spark):
    # n / 2 leaves hang from a spine: all paths together have n * n / 8 messages, the chosen one n / 2
    n = 4000
    rows = [(1, i, i - 2 if i % 2 == 0 and i else (i - 1 if i % 2 else None), "user", str(i), 1.0 if i == n - 1 else 0.0) for i in range(n)]
    messages = spark.createDataFrame(rows, "tree int, node int, parent int, role string, text string, score double")
    jumps, leaves = chat.ancestors(messages)
    best = chat.ranked(leaves, 1)
    found = chat.paths(best, jumps)
    assert leaves.count() == n // 2 and best.first().leaf == n - 1 and found.count() == n // 2 + 1
    assert sum(j.count() for j in jumps) < n * 12


# 6 quality rules


def test_quality_counts_are_brute_force(spark):
    rng = random.Random(4)
    pool = [*WORDS[:5], "#", "\n", "\r\n", "a|b", "\x85", "\xa0", "\x1c", "  "]
    docs = [(k, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for k in range(200)] + [(900, None), (901, "")]
    found = quality.rule_counts(frame(spark, docs)).collect()
    wanted = dict(docs)
    assert all(tuple(r[c] for c in quality.COUNTS) == brute_counts(wanted[r.doc_id]) for r in found) and len(found) == len(docs)


def test_bad_hosts_take_their_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(k, good if k % 10 == 0 else "short", "bad") for k in range(400)] + [(1000 + k, good, "good") for k in range(400)] + [(5000, good, None), (5001, None, None)]
    found = {r.doc_id: r.kept for r in quality.judge(frame(spark, rows, "doc_id long, text string, source string"), max_rate=0.5).collect()}
    assert not any(found[k] for k in range(400)) and all(found[1000 + k] for k in range(400))
    assert found[5000] and not found[5001]
    assert quality.judge(frame(spark, [], "doc_id long, text string, source string")).count() == 0
    clash = quality.judge(frame(spark, [(1, good, "s", 3)], "doc_id long, text string, source string, Kept int"))
    assert clash.columns.count("kept") == 1 and "Kept" not in clash.columns


# 7 token files and 9 BPE


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(1)
    pool = "aAéÉβΣσ ıİſß\t\n \x85\x1c\x00​🙂日本語7٣½<|>endoftext'sSlLrRe_-.…ﬁ́Ǆ "
    made = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    return made + ["a<|endoftext|>b  <|endoftext|> x", "<|startoftext|><|ENDOFTEXT|>", "ΣΑΣ Σ", "I'LL we've", "x" * 5000, "日本" * 3000, "", "\n\n  a"]


def test_bpe_is_the_librarys(odd):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()
    own = bpe.codec(open(path, encoding="utf-8").read())
    for text, want in zip(odd, library.encode_batch(odd, add_special_tokens=False)):
        got = own.encode(text)
        assert got.tolist() == want.ids and own.decode(got) == library.decode(want.ids, skip_special_tokens=False)
    assert any(len(own.fragments(w)) > 1 for t in odd for w, _ in own.split.pre_tokenize_str(own.normalise.normalize_str(t)))


def test_encode_takes_edges(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    rows = [(i, t, "z") for i, t in EDGE]
    found = bpe.encode(frame(spark, rows, "doc_id long, text string, IDS string"), public_tokenizers.path("word_bpe_49k.json"), digests=True)
    assert found.count() == len(rows) and found.where("doc_id = 1").first().n_tokens == 0
    assert bpe.encode(frame(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_numbers_survive_packing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        numbers = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert (tokenfiles.unpack(*tokenfiles.pack(numbers), n) == numbers).all()


def test_token_files_round_trip(spark, odd, tmp_path):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = [(3 * k % 1511, t) for k, t in enumerate(odd)] + [(None, "no id"), (7000, None)]
    tokenfiles.write(frame(spark, docs), str(tmp_path / "t"), path)
    found = sorted(tokenfiles.read(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(path)
    assert [r.key for r in found] == sorted((k for k, _ in docs), key=lambda k: (k is not None, k or 0))
    by = {}
    for k, t in docs:
        by.setdefault(k, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    start = 0
    for r in found:
        assert r.start == start and r["ids"] in by[r.key] and r.n_tokens == len(r["ids"])
        assert r.ids_crc32 == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r.n_tokens
    tokenfiles.write(frame(spark, []), str(tmp_path / "none"), path)
    assert tokenfiles.read(spark, str(tmp_path / "none")).count() == 0


# 8 sharding


def test_shards_are_even_whole_and_repeatable(spark, tmp_path):
    rows = [(k % 90 if k % 7 else None, f"t{k}", k) for k in range(500)]
    docs = frame(spark, rows, "doc_id long, text string, Shard int")
    one = shuffling.shuffled(docs, 7, bucket_bytes=30 * 1024).collect()
    two = shuffling.shuffled(docs.repartition(5), 7, bucket_bytes=30 * 1024).collect()
    place = lambda found: {r.text: (r.shard, r.slot) for r in found}
    assert place(one) == place(two) and len(one) == 500
    by = {}
    for r in one:
        by.setdefault(r.shard, []).append(r.slot)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert place(shuffling.shuffled(docs, 7, seed=1).collect()) != place(one)
    assert shuffling.shuffled(docs.limit(0), 7).count() == 0
    assert {r.shard for r in shuffling.shuffled(frame(spark, [(1, "a"), (2, None)]), 5).collect()} <= set(range(5))
    shuffling.write_shards(docs, str(tmp_path / "s"), 7, bucket_bytes=30 * 1024)
    assert place(spark.read.parquet(str(tmp_path / "s")).collect()) == place(one)


def test_no_key_or_row_fills_a_bucket(spark):
    docs = frame(spark, [(7, f"text {k}") for k in range(1000)] + [(8, "equal")] * 1000 + [(None, None)] * 1000)
    sizes = [r["count"] for r in shuffling.scatter(docs, 30).groupBy("_bucket").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 30 and max(sizes) < 160
    long = frame(spark, [(k, "x" * 10_000) for k in range(20)])
    assert long.agg(F.sum(shuffling.row_bytes(long))).first()[0] == 20 * 10_016


class Twister:
    """The generator behind Spark's `shuffle`: a Mersenne twister seeded by two words, and whole numbers below a bound."""

    def __init__(self, seed):
        self.bits = random.Random((seed & 0xFFFFFFFF) << 32)  # the words 0 and seed

    def below(self, n):
        while True:
            bits = self.bits.getrandbits(32) >> 1
            if n & (n - 1) == 0:
                return n * bits >> 31
            if bits - bits % n + n - 1 < 2**31:
                return bits % n

    def permutation(self, n):
        out = [0] * n
        for i in range(n):
            j = self.below(i + 1)
            out[i], out[j] = out[j], i
        return out


def chained_hash(*values):
    """Spark's xxhash64 of columns: each value's bytes, seeded by the hash so far."""
    import xxhash

    h = 42
    for kind, v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if kind == "s" else v.to_bytes(4 if kind == "i" else 8, "little", signed=True), seed=h)
    return h - 2**64 if h >= 2**63 else h


@pytest.mark.parametrize(("shards", "bucket_bytes", "seed"), [(7, 900, 42), (3, 200, 5), (40, 10**9, 42), (1, 60, 9)])
def test_shards_replayed_in_plain_python(spark, shards, bucket_bytes, seed):
    rng = random.Random(shards)
    rows = [(k if k % 11 else None, rng.choice([None, "", "same", "x" * rng.randrange(90), f"text {k}"])) for k in range(220)] + [(5, "again")] * 40 + [(None, None)] * 25
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    buckets = max(1, -(-sum(16 + len(t or "") for _, t in rows) // bucket_bytes))
    copies, held = Counter(), {}
    for k, text in rows:
        row = chained_hash(("l", k), ("s", text))
        bucket = chained_hash(("i", seed), ("l", k), ("l", row), ("l", copies[k, text])) % buckets
        copies[k, text] += 1
        held.setdefault(bucket, []).append((chained_hash(("i", seed + 1), ("l", k)), k is not None, k or 0, row, k, text))
    tasks, at, wanted = -(-buckets // shuffling.BUCKETS_A_TASK), 0, []
    for task in range(tasks):
        twister = Twister(seed + task)
        for bucket in range(task * buckets // tasks, (task + 1) * buckets // tasks):
            members = sorted(held.get(bucket, []), key=lambda m: m[:4])
            for place in twister.permutation(len(members)) if members else []:
                shard = at * shards // len(rows)
                wanted.append((*members[place][4:], shard, at - -(-shard * len(rows) // shards)))
                at += 1
    found = [(r.doc_id, r.text, r.shard, r.slot) for r in shuffling.shuffled(docs, shards, bucket_bytes=bucket_bytes, seed=seed).collect()]
    assert Counter(found) == Counter(wanted)


def test_shards_hold_whole_documents(spark, tmp_path):
    rows = [(k, f"text {k}" * 50) for k in range(300)] + [(5, "equal")] * 30 + [(None, None)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    before = set(os.listdir(shared_dir(spark)))
    found = shuffling.op8_shuffled_shards(spark, str(tmp_path)).collect()
    (path,) = [p for p in set(os.listdir(shared_dir(spark))) - before if p.startswith("shards-")]
    written = spark.read.parquet(f"{shared_dir(spark)}/{path}").collect()
    assert sorted(((r.doc_id, r.text) for r in written), key=str) == sorted(rows, key=str)
    assert sorted((r.doc_id or -1, r.shard, r.slot) for r in written) == sorted((r.doc_id or -1, r.shard, r.slot) for r in found)
    assert len({(r.shard, r.slot) for r in found}) == len(rows)


def test_every_place_is_reached_about_as_often(spark):
    counts = np.zeros((6, 6))
    for seed in range(40):
        for r in shuffling.shuffled(spark.range(6).withColumnRenamed("id", "doc_id").coalesce(1), 1, seed=seed).collect():
            counts[r.doc_id, r.slot] += 1
    assert counts.min() > 0 and counts.max() < 20


# 10 licences


def test_licence_sequences(spark):
    mit = "Copyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this\nsoftware and associated documentation files (the \"Software\"), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nThe software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."
    rows = [(1, mit), (2, "Text.\nLicensed under CC BY-NC 4.0.\nMore."), (3, "// SPDX-License-Identifier: MIT\ncode"), (4, "mit der Zeit"), (5, "Licensed under the Apache License, Version 2.0. Released under the MIT License. Released under the MIT License."), *((10 + k, t) for k, (_, t) in enumerate(EDGE))]
    found = {r.doc_id: r for r in licences.scan(frame(spark, rows)).collect()}
    assert found[1].licences == ["MIT"] and found[1]["sequence"] == ["mit-grant", "mit-keep", "asis-software"] and found[1].n_unused == 0
    assert found[2].licences == ["CC-BY-NC-4.0"] and found[3].licences == ["MIT"] and found[4].licences == []
    assert found[5].licences == ["Apache-2.0", "MIT"] and found[5].n_known == 3
    assert all(found[10 + k].licences == [] for k in range(len(EDGE)))
    assert licences.scan(frame(spark, [])).count() == 0
    assert licences.scan(frame(spark, [(1, "x", 2)], "doc_id long, text string, Licences int")).columns == ["doc_id", "text", "sequence", "n_known", "n_unused", "licences"]


GPL = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version {} of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n"
HEADERS = {
    "GPL-3.0-or-later": GPL.format(3),
    "GPL-2.0-or-later": GPL.format(2),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n",
    "Apache-2.0": 'Copyright 2020 X\n\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language.\n',
    "MIT": 'Copyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS BE LIABLE.\n',
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n",
}
IDS = {"GPL-3.0-or-later": "gpl-3.0-or-later,gpl-hope", "GPL-2.0-or-later": "gpl-2.0-or-later,gpl-hope", "MPL-2.0": "mpl-2.0-notice", "Apache-2.0": "apache-2.0-notice,apache-2.0-compliance,apache-2.0-asis", "MIT": "mit-grant,mit-keep,asis-software", "BSD-3-Clause": "bsd-grant,bsd-source,bsd-binary,bsd-endorse"}


def test_wrapped_headers(spark):
    forms = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: t.replace("\n", "\r")]
    forms += [lambda t, m=m: "".join(f"{m} {line}\n" for line in t.split("\n")) for m in (" *", "#", "//", "--", ";;", "  ")]
    # as narrow as can be: a line for each word of a paragraph
    forms += [lambda t: "\n\n".join("\n".join(p.split()) for p in t.split("\n\n"))]
    rows = [(i * 10 + k, form(text)) for i, form in enumerate(forms) for k, text in enumerate(HEADERS.values())]
    found = {r.doc_id: r for r in licences.scan(frame(spark, rows)).collect()}
    for i in range(len(forms)):
        for k, name in enumerate(HEADERS):
            assert (",".join(found[i * 10 + k]["sequence"]), found[i * 10 + k].licences) == (IDS[name], [name]), (i, name)


def test_every_known_sentence_is_searched_for(spark):
    written = lambda t: t.replace(f"{licences.TAG} ", "SPDX-License-Identifier: ").replace(licences.UNDER, "Licensed under the ")
    every = list(licences.KNOWN.items())
    rows = [(k, written(t)) for k, (t, _) in enumerate(every)] + [(5001, "Licensed under the\n\nMIT License"), (5002, "mit"), (5003, "x licensed under the mit license")]
    found = {r.doc_id: r for r in licences.scan(frame(spark, rows)).collect()}
    assert all(found[k]["sequence"] == [i] for k, (_, i) in enumerate(every)) and all(found[k]["sequence"] == [] for k in (5001, 5002, 5003))
    assert all(found[k].licences == ([licences.ALONE[i]] if i in licences.ALONE else []) for k, (_, i) in enumerate(every))
    assert len(set(licences.ALONE.values())) > 200


BSD_ASIS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\nIMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE\nDISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE.\n'
WHOLE = {
    "AGPL-3.0-or-later": GPL.format(3).replace("General", "Affero General"),
    "LGPL-2.1-or-later": GPL.format("2.1").replace("General", "Lesser General").replace("This program is d", "This library is d"),
    "BSD-2-Clause": HEADERS["BSD-3-Clause"].split("3. Neither")[0] + BSD_ASIS,
    "BSD-3-Clause": HEADERS["BSD-3-Clause"] + "\n" + BSD_ASIS,
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY\nAND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.\n',
    "Zlib": "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n",
    "GPL-3.0-or-later WITH GCC-exception-3.1": GPL.format(3) + "\nUnder Section 7 of GPL version 3, you are granted additional\npermissions described in the GCC Runtime Library Exception, version\n3.1, as published by the Free Software Foundation.\n",
    "GPL-3.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007\n",
    "MIT OR Apache-2.0": "# SPDX-License-Identifier: MIT OR Apache-2.0\nx = 1\n",
    "GPL-2.0 WITH Linux-syscall-note": "/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */\n#define X\n",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.\n",
    "MPL-1.1": "released under the Mozilla Public License, version 1.1",
}


def test_whole_texts(spark):
    rows = [(k, text) for k, text in enumerate(WHOLE.values())] + [(100, BSD_ASIS), (101, "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; so.")]
    found = {r.doc_id: r for r in licences.scan(frame(spark, rows)).collect()}
    assert [found[k].licences for k in range(len(WHOLE))] == [[name] for name in WHOLE]
    assert (found[100]["sequence"], found[100].n_unused, found[101]["sequence"]) == (["bsd-asis"], 1, ["gpl-hope"])
