"""Importance resampling, the Merkle manifest and source mixing against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from monsoon.llm import merkle, mixing, resample
from monsoon.llm.common import Scratch
from monsoon.llm.ranges import ranked


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plan(df):
    return df._jdf.queryExecution().toString()


# ---- ranks


def test_ranks_are_a_total_order_even_where_keys_are_equal(spark):
    rows = [(i, 7 if i % 3 else i) for i in range(3000)]
    got = ranked(Scratch(spark, "t"), spark.createDataFrame(rows, "id long, k long"), [F.col("k").desc(), F.col("id")]).collect()
    assert [g.id for g in sorted(got, key=lambda g: g["rank"])] == [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert sorted(g["rank"] for g in got) == list(range(1, 3001))
    assert ranked(Scratch(spark, "t"), spark.createDataFrame([], "id long, k long"), [F.col("k")]).collect() == []


# ---- resampling


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_resample(docs, target):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = (Counter(bucket(g) for _, text in rows for g in grams(text)[1]) for rows in (docs, target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10000) / ((s[b] + 1.0) * (all_t + 10000)))) for b in s}
    out = []
    for i, text in docs:
        w, g = grams(text)
        x = int(h(f"42:{'' if i is None else i}")[:8], 16)
        weight = sum(gain[bucket(x)] for x in g)
        out.append((i, len(w), len(g), weight, weight + math.floor(-1000 * math.log(-math.log((x + 0.5) / 2**32)))))
    long = sorted((-score, i is None, i or 0) for i, n, _, _, score in out if n >= 20)
    return out, long[: 5 * len(long) // 100]


def corpus(n=260):
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéß漢Z9") for _ in range(r.randint(1, 4))) for _ in range(60)]
    rows = [(i, (" " if i % 2 else "-\n").join(r.choice(vocabulary) for _ in range(r.randint(1, 60)))) for i in range(n)]
    return rows + [(900, None), (901, ""), (902, " .,! "), (None, rows[3][1]), (3, rows[3][1]), (903, "x " * 40_000), (904, "Ab" * 50_000)]


def test_resampling_equals_brute_force(spark):
    docs, target = corpus(), [(1, "aé bß c " * 30), (2, None), (3, corpus()[7][1])]
    got = resample.importance(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string")).collect()
    expected, drawn = brute_resample(docs, target)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(g.id, g.n_words, g.n_features, g.weight, g.score) for g in got], key=key) == sorted(expected, key=key)
    taken = sorted((g for g in got if g["rank"]), key=lambda g: g["rank"])
    assert [g["rank"] for g in taken] == list(range(1, len(drawn) + 1)) and len(drawn) > 5
    assert [(-g.score, g.id is None, g.id or 0) for g in taken] == drawn


def test_resampling_is_native_and_returns_whole_rows(spark):
    docs = spark.createDataFrame([(i, t, i, "b") for i, t in corpus()], "doc_id long, text string, row long, bucket string")
    target = spark.createDataFrame([("aé bß c " * 30, 1)], "text string, word int")
    found = resample.resample(spark, docs, target, resample.Resample(share_num=20))
    assert not re.search("Python|Arrow|Pandas|ExistingRDD.*text", plan(found))
    rows = found.collect()
    texts = dict(corpus())
    assert len(rows) > 20 and all(texts[r.doc.doc_id] == r.doc.text and r.doc.bucket == "b" for r in rows if r.doc.doc_id is not None)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 30), (2, None)], "doc_id long, text string")
    assert resample.importance(spark, none, some).collect() == []
    got = {r.id: r for r in resample.importance(spark, some, none, resample.Resample(share_num=100)).collect()}
    assert got[1]["rank"] == 1 and got[1].n_features == 60 + 59 + 58 and (got[2].n_features, got[2].weight, got[2]["rank"]) == (0, 0, None)


# ---- manifest


def brute_tree(nodes, fan=16):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def brute_path(levels, i, fan=16):
    for level in levels[:-1]:
        at = i // fan * fan
        yield "".join(level[at:i]), "".join(level[i + 1 : at + fan])
        i //= fan


def brute_manifest(leaves, fan=16):
    """leaves: (id, group, leaf, claimed)."""
    groups = {}
    for x in sorted(leaves, key=lambda x: (x[0] is None, x[0] or 0, x[2])):
        groups.setdefault(x[1], []).append(x)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([x[2] for x in groups[g]], fan) for g in names}
    top = brute_tree([trees[g][-1][0] for g in names], fan)
    out = []
    for k, g in enumerate(names):
        for i, (ident, _, leaf, claimed) in enumerate(groups[g]):
            path = [*brute_path(trees[g], i, fan), *brute_path(top, k, fan)]
            root = claimed or leaf
            for before, after in path:
                root = h(before, root, after)
            out.append((ident, g, leaf, trees[g][-1][0], top[-1][0], h(*[x for p in path for x in p]), root, root == top[-1][0]))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r[:1]) + (str(r),))


@pytest.mark.parametrize("sizes", [{"a": 700, None: 40, "é": 1, "z": 256, "": 17}, {f"g{i}": i % 5 + 1 for i in range(70)}, {"one": 1}, {None: 600}])
@pytest.mark.parametrize("parts", ["3", "16"])
def test_manifest_equals_brute_force(spark, sizes, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        leaves, n = [], 0
        for g, size in sizes.items():
            for _ in range(size):
                n += 1
                leaves.append((n * 37 % 4001, g, h(str(n)), h("x", str(n)) if n % 5 == 0 else None))
        random.Random(1).shuffle(leaves)
        frame = spark.createDataFrame(leaves, "id long, `group` string, leaf string, claimed string")
        got = merkle.manifest(spark, frame, merkle.Manifest(proofs=True)).collect()
        assert order([tuple(r)[:8] for r in got]) == order(brute_manifest(leaves))
        assert all(merkle.fold(r.leaf, r.proof) == r.root and r.verified == (r.folded_root == r.root) for r in got)
        assert sum(not r.verified for r in got) == sum(c is not None for *_, c in leaves)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_manifest_of_odd_rows(spark):
    same = [(5, "s", h("same"), None)] * 400 + [(None, "s", h(str(i)), None) for i in range(50)]
    frame = spark.createDataFrame(same, "id long, `group` string, leaf string, claimed string")
    assert order([tuple(r)[:8] for r in merkle.manifest(spark, frame, merkle.Manifest(fan=4)).collect()]) == order(brute_manifest(same, 4))
    assert merkle.manifest(spark, frame.where("false")).collect() == []
    text = spark.createDataFrame([("é:", None, 12), (None, "", None)], "a string, b string, c int")
    assert [r[0] for r in text.select(merkle.leaf([F.col("a"), F.col("b"), F.col("c")])).collect()] == [h("3:é:-2:12"), h("-0:-")]


def test_runs_of_a_tree_grown_in_pieces_give_the_whole_tree():
    r = random.Random(9)
    for total in (1, 2, 15, 16, 17, 255, 257, 700):
        for fan in (2, 16):
            nodes = [h(str(i)) for i in range(total)]
            cuts = sorted({0, total, *(r.randrange(total + 1) for _ in range(4))})
            known = {}
            for a, b in zip(cuts, cuts[1:]):
                levels = merkle.grow(a, nodes[a:b], total, fan)
                for level, number, node, of in merkle.ragged(levels, total, fan):
                    assert known.setdefault((level, number), (node, of)) == (node, of)
            tree = brute_tree(nodes, fan)
            for level in range(len(tree)):  # every parent's children are there once the levels below are finished
                for number, node in enumerate(tree[level]):
                    if (level, number) in known:
                        assert known[level, number] == (node, len(tree[level]))
            left = {k[0] for k in known}
            assert left <= set(range(len(tree)))
            if len(cuts) == 2:
                assert list(known) == [(len(tree) - 1, 0)]


# ---- mixing


def brute_mix(docs, weights=(5, 2, 1)):
    """docs: (id, source, size, quality)."""
    sizes = Counter()
    for _, s, n, _ in docs:
        sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    level, full = 0.0, None
    while True:
        above = {s for s in names if level * w[s] > 2 * sizes[s]}
        if above == full or len(above) == len(names):
            break
        full, level = above, (1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in above)) / sum(w[s] for s in names if s not in above)
    target = {s: min(level * w[s], 2.0 * sizes[s]) for s in names}
    out = []
    for s in names:
        key = lambda d: (-math.log((int(h(f"42:{'' if d[0] is None else d[0]}")[:13], 16) + 0.5) / 2**52) / d[3], d[0] is None, d[0] or 0)
        epochs = int(target[s] // sizes[s]) if sizes[s] else 0
        left = math.floor(target[s] - epochs * sizes[s] + 0.5)
        for d in sorted((d for d in docs if d[1] == s), key=key):
            take = min(d[2], left)
            left -= take
            out.append((d[0], s, d[2], sizes[s], target[s], epochs * d[2] + take))
    return out


def mixed(rows):
    return sorted([(*r[:4], round(r[4], 6), r[5]) for r in rows], key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_mixing_equals_brute_force(spark):
    r = random.Random(3)
    docs = [(i, r.choice(["a", "a", "a", "a", "b", "c", "é", None, "d"]), r.randint(0, 40), r.choice([0.5, 1.0, 2.0])) for i in range(700)]
    docs += [(None, "b", 7, 1.0), (2000, "tiny", 1, 1.0), (2001, "empty", 0, 1.0), (2002, "long", 30_000, 1.0)]
    frame = spark.createDataFrame([(i, s, " \t".join(["w,é"] * n) if n else None, q, "x") for i, s, n, q in docs], "doc_id long, source string, text string, q double, key string")
    got = mixing.mix(spark, frame, quality=F.col("q"))
    rows = [(g.id, g.source, g.size, g.source_size, g.target, g.taken) for g in got.collect()]
    assert mixed(rows) == mixed(brute_mix(docs))
    sums = Counter()
    for _, s, _, _, _, taken in rows:
        sums[s] += taken
    targets = {x[1]: x[4] for x in rows}
    assert all(abs(sums[s] - targets[s]) <= 0.5 for s in targets) and all(x[5] <= 2 * x[2] for x in rows)
    assert math.isclose(sum(targets.values()), 1.5 * sum(d[2] for d in docs))
    ratings = frame.where("doc_id is not null").select(F.col("doc_id").alias("id"), F.col("q").alias("quality"))
    again = mixing.mix(spark, frame.repartition(7), mixing.Mix(broadcast_sources=0), ratings=ratings).collect()
    assert mixed([(g.id, g.source, g.size, g.source_size, g.target, g.taken) for g in again]) == mixed(rows)


def test_the_mix_has_whole_copies_and_one_cut_text_a_source(spark):
    docs = [(i, "ab"[i % 5 == 0], " ".join(f"w{j}" for j in range(i % 7 + 1))) for i in range(60)]
    frame = spark.createDataFrame([(i, s, t, "k") for i, s, t in docs], "doc_id long, source string, text string, copies string")
    rows = mixing.mixture(spark, frame).collect()
    taken = {(g.id): g.taken for g in mixing.mix(spark, frame).collect()}
    words = Counter()
    for r in rows:
        words[r.doc.doc_id] += len(r.text.split())
        assert r.doc.text.startswith(r.text)
    assert {k: v for k, v in taken.items() if v} == dict(words)
    assert len([r for r in rows if r.text != r.doc.text]) <= 2


def test_mixing_of_nothing_and_of_one_source(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(spark, none).collect() == [] and mixing.mixture(spark, none).collect() == []
    wordless = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix(spark, wordless).collect())
    same = spark.createDataFrame([(1, "a", "x y")] * 300, "doc_id long, source string, text string")
    got = mixing.mix(spark, same).collect()
    assert sum(r.taken for r in got) == 900 and {r.taken for r in got} == {2, 4}
