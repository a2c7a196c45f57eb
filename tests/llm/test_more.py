"""Operators 11 to 13 against plain versions, on small and awkward inputs."""

import hashlib
import itertools
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import SF, duck, rows_of

from tideline.llm import classifier, periods, queries, turns

DOC = "doc_id bigint, text string, lang string, score double, starts string, collapsed string, predicted string"
AWKWARD = [None, "", "   \n\t", "a", "日本語 テキスト", "é" * 3, "word " * 5000, "\x1c \x85  ", "x" * 100_000, "a\x0bb\x0ca b\x0ba b a b a b"]


def docs_of(spark, texts):
    return spark.createDataFrame([(*(t if isinstance(t, tuple) else (i, t)), None, 1.5, "s", "c", "p") for i, t in enumerate(texts)], DOC)


# 11 quality classifier


def test_forest_walks_like_its_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = classifier.fit(x, y, trees=40, depth=3)
    assert ((forest.score(x) > 0.5) == (y > 0.5)).mean() > 0.97
    codes = forest.codes(x)
    for row, raw in zip(codes[:50], forest.raw(codes[:50]), strict=True):
        total = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.bin, forest.leaf, strict=True):
            at = 0
            while at < len(feature):
                at = 2 * at + (1 if row[feature[at]] <= cut[at] else 2)
            total += leaf[at - len(feature)]
        assert np.isclose(total, raw)
    again = classifier.fit(x, y, trees=40, depth=3)
    assert (again.leaf == forest.leaf).all() and (again.feature == forest.feature).all()


def test_forest_of_one_class_and_of_nothing():
    for y, score in ((np.ones(8), 0.9), (np.zeros(8), 0.1), (np.zeros(0), 0.5)):
        forest = classifier.fit(np.zeros((len(y), 2)), y)
        assert np.allclose(forest.score(np.ones((3, 2))), score)


def test_classifier_edges(spark):
    docs = docs_of(spark, [*AWKWARD, (None, "a b"), (1, "c"), (1, "c")])
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0), (None, 0), (6, 1)], "doc_id bigint, quality int")
    forest = classifier.train(docs, labels)
    out = classifier.classify(docs, forest).collect()
    assert len(out) == len(AWKWARD) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert len({r.score for r in out if r.doc_id == 1}) <= 2
    assert classifier.classify(docs.where("false"), classifier.train(docs.where("false"), labels)).isEmpty()
    assert all(np.isfinite(classifier.statistics(t)).all() and len(classifier.statistics(t)) == len(classifier.FEATURES) for t in AWKWARD)


def test_classifier_learns_nothing_held_out(spark):
    """Labels of held-out documents turned round change no score."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = F.coalesce(classifier.held_out(), F.lit(False))
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (classifier.train(docs, x.where(~out)) for x in (labels, turned))
    assert (one.leaf == two.leaf).all()
    rows = {r.doc_id: r for r in queries.op11_quality_classifier(spark, SF).collect()}
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values())


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op11_quality_classifier(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("score", "predicted", "quality").toPandas()
    ranks, good = got.score.rank(), got.quality == 1
    auc = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert len(got) > 500 and auc > 0.98 and (got.predicted == got.quality).mean() > 0.97


# 12 periodic runs


def plain_lyndon(w):
    out = []
    for i in range(len(w)):
        j = i + 1
        while j < len(w) and w[j:] > w[i:]:
            j += 1
        out.append(j - i)
    return out


def plain_runs(w, least=6, times=4):
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(least, times * q) and not any(all(w[j] == w[j + d] for j in range(s, s + length - d)) for d in range(1, q)):
                out.add((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 7)), max_size=7)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_lyndon_groups_and_runs(parts):
    w = [x for block, times in parts for x in block * times]
    ranks = [sorted(set(w)).index(x) for x in w]
    group, length = periods.lyndon_groups(ranks)
    assert length.tolist() == plain_lyndon(ranks)
    roots = {}
    for i, g in enumerate(group.tolist()):
        roots.setdefault(g, set()).add(tuple(w[i : i + length[i]]))
    assert all(len(r) == 1 for r in roots.values())
    words = [str(x).encode() for x in w]
    for least, times in ((6, 4), (2, 2), (3, 3), (9, 2)):
        assert periods.find_runs(words, least, times) == plain_runs(w, least, times)


def test_runs_at_stretch_ends_and_ties(spark):
    texts = ["a b a b a b a b", "x a a a a a a y", "a a a a a", "a a a a a a b b b b b b", "p q r " * 4 + "p z " + "p q r " * 4, "a b " * 6 + "c " + "a b " * 6]
    out = {r.doc_id: r for r in periods.digest(periods.collapse(docs_of(spark, texts))).collect()}
    got = [(r.n_runs, r.start, r.length, r.period, r.exponent_milli) for _, r in sorted(out.items())]
    assert got == [(1, 0, 8, 2, 4000), (1, 1, 6, 1, 6000), (0, None, None, None, None), (2, 0, 6, 1, 6000), (2, 0, 13, 3, 4333), (2, 0, 12, 2, 6000)]
    assert out[3].runs_sha256 == hashlib.sha256(b"0,6,1\n6,6,1\n").hexdigest() and out[3].collapsed_sha256 == hashlib.sha256(b"a b").hexdigest()
    assert out[2].runs_sha256 == hashlib.sha256(b"").hexdigest() and out[5].collapsed_sha256 == hashlib.sha256(b"a b c a b").hexdigest()


def test_runs_of_damaged_and_awkward_texts(spark):
    rng = random.Random(5)
    texts = [*AWKWARD, *(" ".join(rng.choice("abcd") * rng.randint(1, 2) for _ in range(rng.randint(1, 90))) for _ in range(120)), (None, "a " * 9), (7, "b " * 9), (7, "b " * 9)]
    docs = docs_of(spark, texts)
    out = periods.collapse(docs, damaged=True).collect()
    assert len(out) == len(texts)
    for r, (i, t) in zip(out, ((i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)), strict=True):
        w = [x for x in re.split("[ \t\n\v\f\r]+", t or "") if x]
        h, n = zlib.crc32(str(i).encode()), len(w)
        if i is not None and h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w) if len(w) < 1000 else [(0, n, 1)]
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        assert r.doc_id == i and r.n_words == n and list(zip(r.starts, r.lengths, r.periods)) == runs
        assert r.collapsed == " ".join(x for k, x in enumerate(w) if k not in gone)
    assert periods.digest(periods.collapse(docs.where("false"), damaged=True)).isEmpty()


# 13 conversations


def cheapest(rows):
    """By trying all edits: (cost, audit) of rows of (initial, fault)."""
    best = (2 * len(rows), "D" * len(rows))
    following = {"": "su", "s": "u", "u": "a", "a": "u"}

    def go(i, last, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(rows) and last in ("", "a"):
            best = min(best, (cost, audit))
        if i < len(rows):
            c, fault = rows[i]
            go(i + 1, last, cost + 2, audit + "D")
            more = 5 if fault == turns.TRUNCATED else 0
            if fault not in (turns.BLANK, turns.DUPLICATE):
                if c and c in following[last]:
                    go(i + 1, c, cost + more, audit + "K")
                for r in set("ua") & set(following[last]):
                    go(i + 1, r, cost + 1 + more, audit + "R")
        for r in set("ua") & set(following[last]):
            go(i, r, cost + 5, audit + "I")

    go(0, "", 0, "")
    return best


def searched(rows):
    s, out = turns.Search(), []
    for i, (c, fault) in enumerate(rows):
        out += list(s.turn(i, c, fault))
    cost, rest = s.end(len(rows))
    return cost, "".join(letters for _, letters, _ in [*out, *rest])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", "", " "]), st.sampled_from([0, 0, 0, 0, 1, 2, 3])), max_size=7))
def test_cheapest_edits(rows):
    assert searched(rows) == cheapest(rows)


def test_cheapest_edits_of_ties():
    for n in range(7):
        for roles in itertools.product("uas", repeat=n):
            rows = [(c, 0) for c in roles]
            assert searched(rows) == cheapest(rows)


def test_survivors_merge():
    """Edits come out while a long conversation is read, and the tree stays small, unless two repairs stay equally good."""
    s, emitted, most = turns.Search(), 0, 0
    for i in range(20_000):
        emitted += len(list(s.turn(i, "sua"[min(i, 1) + (i > 0 and i % 2 == 0)] if i else "s", 0 if i % 50 else turns.BLANK)))
        most = max(most, len(s.tree.parent) - len(s.tree.free))
    assert emitted > 19_900 and most < 200 and len(s.tree.parent) < 400
    even, odd = searched([("u", 0)] * 2000), searched([("u", 0)] * 2001)
    assert even == (1000, "KR" * 1000) and odd == (1002, "D" + "KR" * 1000)


CONV = "conv_id bigint, turn int, role string, text string, place string, edit string, cost string, audit string"


def test_damage_and_report_of_awkward_rows(spark):
    rng = random.Random(8)
    roles, texts = ["system", "user", "assistant", "tool", "", None], ["Yes.", "No!", "open", "", " \n", None, "Yes.", "a\x1f", "ok? \t", "x" * 3000 + "."]
    rows = [(c, t, rng.choice(roles), rng.choice(texts)) for c in (*range(60), None) for t in (*rng.sample(range(9), rng.randint(0, 6)), *([None] * (rng.random() < 0.2)))]
    rows += [(60, 0, "user", "Hi."), (60, 0, "user", "Hi."), (61, 3, "assistant", "So.")]
    df = spark.createDataFrame([(*r, "p", "e", "c", "a") for r in rows], CONV)
    got = {r.conv_id: r for r in turns.report(df, turns.damage(df)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        kept = []
        for c, t, role, text in rows:
            if c != conv:
                continue
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept += [(t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, faulty = set(), []
        for _, role, text in kept:
            body = text.strip(" \t\n\v\f\r")
            faulty.append((role[:1], turns.BLANK if not body else turns.DUPLICATE if (role, text) in seen else turns.TRUNCATED if body[-1] not in ".!?" else turns.FINE))
            seen.add((role, text))
        cost, audit = searched(faulty)
        out, at, last = [], 0, ""
        for letter in audit:
            made = "assistant" if last == "u" else "user"
            if letter == "I":
                out.append((made, ""))
            else:
                if letter in "KR":
                    out.append((kept[at][1] if letter == "K" else made, kept[at][2]))
                at += 1
            last = out[-1][0][:1] if out else ""
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in out))
        numbers = [t for t, _, _ in kept if t is not None]
        initials = [c for c, _ in faulty]
        expected = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(sum(f == k for _, f in faulty) for k in (turns.BLANK, turns.DUPLICATE, turns.TRUNCATED)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest(),
        )
        assert tuple(r)[1:] == expected, conv
    assert turns.report(df.where("false"), turns.damage(df.where("false"))).isEmpty()


@pytest.mark.parametrize("name", ["op12_periodic_runs", "op13_conversation_repair"])
def test_against_sql_at_a_larger_size(spark, name):
    sf = "/root/testdata/sf0.01"
    names, rows = rows_of(queries.QUERIES[name](spark, sf).toArrow())
    expected_names, expected = duck(queries.ORACLES[name], sf)
    assert names == expected_names and rows == expected
