"""Line dedup, decontamination, near-duplicates, language ID, pieces and token counts on small tables."""

import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from monsoon.llm import decontam, langid, linededup, minhash, pieces, tokencounts
from monsoon.llm.common import Scratch
from monsoon.llm.components import components
from monsoon.llm.textcode import shingle_sets

DOCS = "doc_id bigint, text string, lang string"
ODD = [(None, "a b c d e f", "en"), (7, None, "en"), (8, "", None), (9, " \n\t", "en"), (9, "x", None), (9, "x", None)]


def frame(spark, rows):
    """Rows with extra columns whose names clash with those used inside."""
    return spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit("own"), "ident": F.lit(1), "digest": F.lit(2), "node": F.lit(3), "n": F.lit(4), "a.b": F.lit(5)})


def lines_left(rows, window=3):
    """Brute force: rows (key, lines) in order; later occurrences of windows lose their lines."""
    seen, out = set(), {}
    for key, lines in rows:
        gone = set()
        for i in range(len(lines) - window + 1):
            w = tuple(lines[i : i + window])
            if w in seen:
                gone |= set(range(i, i + window))
            seen.add(w)
        out[key] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(3)
    rows = [(i, "\n".join(r.choice("abc") for _ in range(r.randint(0, 9))), "en") for i in range(60)]
    expected = lines_left([(i, t.split("\n")) for i, t, _ in rows])
    got = linededup.dedup_lines(spark, frame(spark, rows)).select("doc.doc_id", "text", "n_lines", "n_removed").collect()
    assert {g.doc_id: g.text for g in got} == expected
    assert all(g.n_removed == (g.n_lines - len(g.text.split("\n")) if g.text or not g.n_removed else g.n_lines) for g in got)


def test_line_dedup_odd_rows(spark):
    passage = "p\nq\nr\ns"
    df = frame(spark, [*ODD, (1, passage, "en"), (1, passage, "en"), (2, passage + "\nend", "en"), (None, passage, "en")])
    got = [(g.doc_id, g.text, g.n_removed) for g in linededup.dedup_lines(spark, df).select("doc.doc_id", "text", "n_removed").collect()]
    assert got.count((1, passage, 0)) == 2 and (2, "end", 4) in got and (None, "", 4) in got and (7, None, 0) in got and len(got) == 10
    assert linededup.dedup_lines(spark, frame(spark, [])).count() == 0


WORDS = [f"w{i}" for i in range(400)]


def near_set(r):
    base = [r.choice(WORDS) for _ in range(120)]
    out = []
    for _ in range(25):
        copy = list(base)
        for _ in range(r.randint(0, 9)):
            copy[r.randrange(len(copy))] = r.choice(WORDS)
        out.append(copy)
    return out


def brute_components(texts, k, num, den):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return sets, label


@pytest.mark.parametrize("conf", [minhash.MinHash(k=3, share_num=85), minhash.MinHash(k=3, share_num=85, small=2, block=8, pivots=1), minhash.MinHash(k=3, share_num=85, small=2, block_bytes=3000, salts=3, pivots=1)])
def test_near_duplicates_equal_brute_force(spark, conf):
    r = random.Random(5)
    texts = [" ".join(t) for t in near_set(r) + near_set(r)] + [" ".join(r.choice(WORDS) for _ in range(40)) for _ in range(20)] + ["One two", "one TWO", "", None, "one", " \n "]
    sets, label = brute_components(texts, 3, 85, 100)
    got = {g.id: g for g in minhash.near_duplicates(spark, frame(spark, [(i, t, "en") for i, t in enumerate(texts)]), conf).collect()}
    assert {i: g.component_id for i, g in got.items()} == dict(enumerate(label))
    assert all(g.n_shingles == len(sets[i]) and g.kept == (label[i] == i) for i, g in got.items())


def test_near_duplicates_odd_rows(spark):
    text = "a b c d e f g"
    got = [(g.id, g.component_id, g.kept) for g in minhash.near_duplicates(spark, frame(spark, [*ODD, (3, text, "en"), (2, text, "en"), (2, text, "en"), (None, text, None)])).collect()]
    assert got.count((2, 2, True)) == 2 and (3, 2, False) in got and (None, 2, False) in got and (7, 7, True) in got and len(got) == 10
    assert minhash.near_duplicates(spark, frame(spark, [])).count() == 0


def test_shingles_and_pruning():
    texts = [b"A b  c\td", "é x \u00a0 y".encode(), b"", None, b"one"]
    assert [len(s) for s in shingle_sets(texts, 3)] == [2, 2, 0, 0, 1]
    assert np.array_equal(*shingle_sets([b"Ab cd ef", b"aB CD  ef"], 3))
    long = b" ".join(b"w%d" % i for i in range(60_000))
    assert len(next(shingle_sets([long], 5))) == 59_996
    looks = minhash.MinHash(k=3, share_num=85).least_matches()
    assert looks[-1][0] == 128 and all(a[1] <= b[1] for a, b in zip(looks, looks[1:], strict=False))


def test_components_of_many_edges(spark, monkeypatch):
    import monsoon.llm.components as c

    monkeypatch.setattr(c, "ONE_TASK_EDGES", 3)
    edges = [(i, i + 1) for i in range(40) if i % 10 != 9] + [(100, 100 + i) for i in range(1, 30)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = components(Scratch(spark, "t"), df).collect()
    groups = {}
    for g in got:
        groups.setdefault(g.root, set()).add(g.node)
    assert sorted(map(sorted, groups.values())) == [list(range(i, i + 10)) for i in (0, 10, 20, 30)] + [list(range(100, 130))]


QUESTION = "Once on a quiet autumn day the tired Alice Brown drives 30 km in 2 hours from the old city to the new harbour then how far does Alice Brown drive in 5 hours at that speed"


def test_templates_catch_other_parameters_but_not_mixed_ones(spark):
    other = QUESTION.replace("Alice Brown", "Karl Gruber").replace("30", "77").replace("5 hours", "9 hours")
    mixed = other.replace("how far does Karl Gruber", "how far does Vera Stone")
    docs = [(1, "Some text before. " + QUESTION + " and after", "en"), (2, "Text before it. " + other, "en"), (3, "Text before it. " + mixed, "en"), (4, "nothing of that kind is found in here at all today", "en"), *ODD]
    items = spark.createDataFrame([(10, QUESTION), (11, None), (12, "tiny words"), (13, "12 34 56")], "item_id bigint, text string").withColumn("id", F.lit(0))
    got = {(g.id, g.item) for g in decontam.leaks(spark, frame(spark, docs), items).collect()}
    assert {(1, 10), (2, 10)} <= got and (4, 10) not in got and {i for _, i in got} == {10}
    assert {g.id: g.share for g in decontam.leaks(spark, frame(spark, docs[:1]), items).collect()}[1] > 0.9
    assert (3, 10) not in got
    assert decontam.leaks(spark, frame(spark, []), items).count() == 0 and decontam.leaks(spark, frame(spark, docs), items.where("false")).count() == 0


def test_words_with_glued_digits_or_names_do_not_shift_values(spark):
    item = QUESTION.replace("2 hours", "5 hours")
    docs = [(i, f"{front} {item}", "en") for i, front in enumerate(["Read this.", "This is the 3rd exercise.", "An mp3 of B2B and the YouTube film with <num> and <name>."])]
    far = QUESTION.replace("from the old city", "in 2 hours") + " while " + " ".join(f"word{c} other{c}" for c in "abcdefghij") + " and 2 more"
    docs.append((9, "This is the 3rd exercise. " + far.replace("and 2 more", "and 4 more"), "en"))  # one conflict at the end costs its windows only
    items = spark.createDataFrame([(10, item), (11, far)], "item_id bigint, text string")
    got = {(g.id, g.item): g.share for g in decontam.leaks(spark, frame(spark, docs), items).collect()}
    assert [got.get((i, 10)) for i in range(3)] == [1.0, 1.0, 1.0] and 0.5 <= got[9, 11] < 1


def test_items_poor_in_literals_and_names_that_begin_sentences(spark):
    sums = "Compute " + " + ".join(str(n) for n in range(12, 90, 7))
    people = "Anna, Bert, Carl, Dora, Emil, Fritz, Gerd and Hugo paid 12, 45, 78, 23, 56, 89, 31 and 64 euros"
    quiz = "What is the capital city of northern Peru?"
    story = "Marta has many old books at home. Paula lends her some more of them. Marta then sells half of all. How many does she still have now?"
    renamed = story.replace("Marta", "Xaver").replace("Paula", "Yvonne")
    items = spark.createDataFrame([(1, sums), (2, people), (3, quiz), (4, story), (5, "7 8 9")], "item_id bigint, text string")
    docs = [(1, f"First this: {sums} and so on", "en"), (2, f"We know that {people} for it.", "en"), (3, f"Here is a quiz question: {quiz} Answer it.", "en"), (4, f"Read. {renamed} End.", "en")]
    docs += [(11, f"First this: {sums.replace('12', '13').replace('40', '41').replace('68', '69')} and so on", "en"), (12, "for 1 2 3 and", "en"), (13, "for 7 8 9 and", "en")]
    docs.append((14, "x " + "1a2b" * 20000 + " Ab" * 20000 + " 1.2" + ".3" * 20000, "en"))  # no regular expression runs out of stack
    got = {(g.id, g.item) for g in decontam.leaks(spark, frame(spark, docs), items).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (13, 5)}


def test_an_instruction_shared_by_all_items_and_documents_makes_no_pairs(spark):
    r = random.Random(2)
    vocabulary = ["".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randint(3, 8))) for _ in range(2000)]
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    order = "please read the following question with care and then give the one answer that fits it best"
    asked = [line(25) for _ in range(120)]
    items = spark.createDataFrame([(i, f"{order} {q}") for i, q in enumerate(asked)], "item_id bigint, text string")
    texts = {i: f"{line(20)} {order} {line(40)}" for i in range(400)} | {1000 + i: f"{line(20)} {order} {asked[i]} {line(5)}" for i in range(5)} | {2000: f"{line(9)} {asked[7]} {line(9)}"}
    docs = frame(spark, [(i, t, "en") for i, t in texts.items()])
    got = [(g.id, g.item, g.matched == g.total) for g in decontam.leaks(spark, docs, items).collect()]
    assert sorted(got) == [*((1000 + i, i, True) for i in range(5)), (2000, 7, False)]


def test_decontamination_without_broadcast_gives_the_same(spark):
    docs = frame(spark, [(i, f"in front {i} " + QUESTION, "en") for i in range(5)])
    items = spark.createDataFrame([(10, QUESTION)], "item_id bigint, text string")
    rows = [sorted((g.id, g.item, g.matched) for g in decontam.leaks(spark, docs, items, decontam.Decontam(broadcast_rows=n)).collect()) for n in (0, 1000)]
    assert rows[0] == rows[1] and len(rows[0]) == 5


def brute_kn(texts, order=2):
    """Interpolated Kneser-Ney bigrams by dictionaries."""
    from collections import Counter

    two = Counter(tuple(c[i : i + 2]) for c in (langid.characters(t).tolist() for t in texts) for i in range(len(c) - 1))
    ends = Counter(b for _, b in two)

    def discount(counts):
        once, twice = (sum(v == n for v in counts.values()) for n in (1, 2))
        return once / (once + 2 * twice) if once else 0.5

    d2, d1 = discount(two), discount(ends)
    floor = 1 / (max(2, len(ends)) + 1)

    def p1(b):
        return max(ends[b] - d1, 0) / sum(ends.values()) + d1 * len(ends) / sum(ends.values()) * floor

    def p2(a, b):
        total = sum(v for k, v in two.items() if k[0] == a)
        return max(two[a, b] - d2, 0) / total + d2 * sum(k[0] == a for k in two) / total * p1(b) if total else p1(b)

    return p2


def test_kneser_ney_equals_dictionaries():
    texts = ["the cat sat", "that hat", "a cat and a hat"]
    keys = np.concatenate([langid.grams(langid.characters(t), 2) for t in texts])
    key, n = np.unique(keys, return_counts=True)
    model = langid.Model(["en"], np.zeros(len(key), np.int64), key, n, 2).freeze()
    p = brute_kn(texts)
    for text in ("the hat", "zebra sat", "x"):
        c = langid.characters(text).tolist()
        expected = -sum(np.log(p(a, b)) for a, b in zip(c, c[1:], strict=False)) / (len(c) - 1)
        assert model.entropy([text])[0][0, 0] == pytest.approx(expected, rel=1e-5)
    long = "the cat " * 120_000
    assert model.entropy([long])[0][0, 0] == pytest.approx(model.entropy(["the cat " * 1000])[0][0, 0], rel=1e-3)


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = langid.held_out(F.col("doc_id"))
    model, threshold = langid.train(spark, docs.where(~fold))
    got = langid.predict(spark, docs.where(fold).select(F.struct("doc_id", "lang").alias("k"), "text"), model, threshold, id_col="k").collect()
    assert np.mean([g.id.lang == g.lang_pred for g in got]) > 0.97 and np.mean([g.rejected for g in got]) < 0.03
    junk = spark.createDataFrame([(1, "ξψζ ωφβ " * 20), (2, None), (3, "12 !!"), (4, "")], "doc_id bigint, text string")
    rows = {g.id: g for g in langid.predict(spark, junk, model, threshold).collect()}
    assert rows[1].rejected and [rows[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and all(0 <= g.score <= 1 for g in rows.values())
    empty, limit = langid.train(spark, docs.where("false"))
    assert {g.lang_pred for g in langid.predict(spark, junk, empty, limit).collect()} == {"und"}


def brute_pieces(v, unknown, word):
    table = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds, strict=True)) if k == pieces.NORMAL}
    best = [0.0]
    for j in range(1, len(word) + 1):
        best.append(max(best[j - n] + (v.scores[table[word[j - n : j]]] if word[j - n : j] in table else unknown if n == 1 else -1e18) for n in range(1, min(j, 16) + 1)))
    return best[-1]


def test_pieces_are_the_best_and_decode_to_the_text(spark):
    with open(pieces.DEFAULT_MODEL, "rb") as file:
        v = pieces.Vocabulary.parse(file.read())
    encoder = pieces.Encoder(v)
    texts = ["hello world", "a  b   c ", " x", "\n\n a\nb", "日本語 \U0001F600 z", "", "Über éèê ß", "x" * 3000, "naïve\tcafé"]
    ids, counts, same = encoder.encode(texts)
    at = 0
    for text, n, ok in zip(texts, counts, same, strict=True):
        own = ids[at : at + n]
        at += n
        assert encoder.decode(own) == text and ok
        if text and text.isalpha() and len(text) < 100:
            assert sum(v.scores[i] for i in own) == pytest.approx(brute_pieces(v, encoder.unknown, "▁" + text))
    for word in ("internationalization", "thhewhst", "Straße"):
        own = encoder.encode([word])[0]
        assert sum(v.scores[i] for i in own) == pytest.approx(brute_pieces(v, encoder.unknown, "▁" + word))
    df = frame(spark, [(1, "hello world", "en"), *ODD])
    coded = pieces.encode(spark, df)
    back = sorted(map(tuple, pieces.decode(spark, coded).collect()), key=repr)
    assert back == sorted(map(tuple, df.select("doc_id", "text").collect()), key=repr)
    assert pieces.encode(spark, frame(spark, [])).count() == 0


def test_token_totals_at_limits(spark):
    df = frame(spark, [(i, "word " * i, "en") for i in range(40)] + ODD)
    sizes = [r.n_tokens for r in tokencounts.lengths(df).collect()]
    hist = tokencounts.histogram(spark, df, block=4)
    got = {r.n_tokens: r for r in hist.collect()}
    assert sorted(got) == sorted(set(sizes))
    for n, r in got.items():
        assert (r.n_docs, r.docs_longer, r.tokens_longer) == (sizes.count(n), sum(s > n for s in sizes), sum(s for s in sizes if s > n))
        assert r.truncated_tokens == sum(min(s, n) for s in sizes) and r.total_tokens == sum(sizes) and r.quantile == pytest.approx(sum(s <= n for s in sizes) / len(sizes))
    limits = {r.context_limit: r for r in tokencounts.at_limits(hist, [0, 7, 1000]).collect()}
    assert limits[7].truncated_tokens == sum(min(s, 7) for s in sizes) and limits[1000].docs_longer == 0
    assert tokencounts.histogram(spark, frame(spark, [])).count() == 0


def test_long_runs_of_blanks_count_as_the_pattern_does(monkeypatch):
    with open(tokencounts.DEFAULT_RANKS, "rb") as file:
        encoding = tokencounts._encoding(file.read())
    assert tokencounts.token_count(encoding, " " * 1_000_000 + "a") > 0 and tokencounts.token_count(encoding, "\n" * 1_200_000 + "x") > 0
    monkeypatch.setattr(tokencounts, "_BLANKS", re.compile(tokencounts._BLANKS.pattern.replace(str(tokencounts.RUN), "3")))
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice([" ", "  ", "\n", "a", "b1", "!", "\t", " ", "'s", "\x1c", "　"]) for _ in range(r.randint(0, 25)))
        assert tokencounts.token_count(encoding, text) == len(encoding.encode_ordinary(text))


def test_sets_are_made_once_for_a_node(spark, monkeypatch):
    seen = {}

    class Kept(Scratch):
        def table(self, df, name):
            seen[name] = super().table(df, name)
            return seen[name]

    monkeypatch.setattr(minhash, "Scratch", Kept)
    r = random.Random(4)
    words = [r.choice(WORDS) for _ in range(80)]
    copies = [" ".join(words[:i] + [f"own{i}"] + words[i + 1 :]) for i in range(40)]
    rows = [(None, copies[i % 40], "en") for i in range(2000)] + [(5, copies[0] + " end", "en")] * 2000
    got = minhash.near_duplicates(spark, frame(spark, rows)).collect()
    assert seen["sets"].count() == 41 and len(got) == 4000 and {g.component_id for g in got} == {5}


def test_statistics_in_spark_equal_the_model_from_counts(spark):
    r = random.Random(9)
    texts = [("".join(r.choice("abcde ") for _ in range(60)), lang) for lang in ("x", "y", "z") for _ in range(20)]
    conf = langid.LangId()
    labelled = spark.createDataFrame(texts, "text string, lang string")
    model, _ = langid.train(spark, labelled, conf)
    learnt = {row.text for row in labelled.where(F.pmod(F.xxhash64("text"), F.lit(conf.folds)) != 0).select("text").collect()}
    arrays = {}
    for i, lang in enumerate("xyz"):
        keys = np.concatenate([langid.grams(langid.characters(t), 4) for t, own in texts if own == lang and t in learnt])
        arrays[i] = np.unique(keys, return_counts=True)
    whole = langid.Model(["x", "y", "z"], np.concatenate([np.full(len(k), i) for i, (k, _) in arrays.items()]), np.concatenate([k for k, _ in arrays.values()]), np.concatenate([n for _, n in arrays.values()]), 4).freeze()
    asked = ["abc de", "eeee", "a q b", "dcba edcba"]
    assert np.allclose(model.entropy(asked)[0], whole.entropy(asked)[0], rtol=1e-5)
    # what isn't stored goes to the shorter gram: every context still has a distribution
    with pytest.warns(UserWarning):
        small, _ = langid.train(spark, labelled, langid.LangId(max_cells=700))
    for before in ("ab", "abc", "e", ""):
        chars = [langid.EDGE, *map(ord, "abcdefgh")]
        wide = langid.characters(before)[:-1].tolist()
        keys = np.concatenate([langid.grams(np.array([*wide, c], np.uint16), 4)[-1:] for c in chars])
        p, q = small._probability(keys, 4), model._probability(keys, 4)
        assert (p > 0).all() and (abs(p[:6].sum(axis=0) - q[:6].sum(axis=0)) < 0.05).all()


@pytest.mark.parametrize("cells", [0, 3000, 60_000])
def test_a_model_above_max_cells_gives_the_same_predictions(spark, cells, monkeypatch):
    monkeypatch.setattr(langid, "_CHUNK", 7)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(-1, None), (None, "12 !!"), (-2, "\u03be\u03c8\u03b6 \u03c9\u03c6\u03b2 " * 40), (-3, "zq"), (-3, "zq"), (-4, "\U00010400\U00010401 a" * 9)], "doc_id bigint, text string")
    asked = docs.select("doc_id", "text").unionByName(odd)
    learnt = docs.where(~langid.held_out(F.col("doc_id")))

    def rows(conf):
        model, threshold = langid.train(spark, learnt, conf)
        found = langid.predict(spark, asked, model, threshold, conf).collect()
        return model, threshold, sorted(found, key=lambda r: (r.id is None, r.id or 0, r.text or ""))

    _, limit, whole = rows(langid.LangId())
    with pytest.warns(UserWarning):
        model, threshold, got = rows(langid.LangId(max_cells=cells))
    assert model.logs.size <= cells and (cells < 60_000 or model.logs.size > 0)
    assert threshold == pytest.approx(limit, abs=0.02) and len(got) == len(whole) == docs.count() + 6
    for g, w in zip(got, whole, strict=True):
        assert (g.id, g.text, g.lang_pred, g.rejected, g.n_chars) == (w.id, w.text, w.lang_pred, w.rejected, w.n_chars)
        assert g.cross_entropy == pytest.approx(w.cross_entropy, abs=1e-5) and g.score == pytest.approx(w.score, abs=1e-4)


def test_joined_grams_have_the_whole_models_probabilities(spark):
    r = random.Random(12)
    texts = [("".join(r.choice(letters) for _ in range(60)), lang) for lang, letters in (("x", "abcd "), ("y", "bcde "), ("z", "fg ")) for _ in range(20)]
    labelled = spark.createDataFrame(texts, "text string, lang string")
    whole, _ = langid.train(spark, labelled, langid.LangId())
    with pytest.warns(UserWarning):
        joined, _ = langid.train(spark, labelled, langid.LangId(max_cells=50))
    # longest grams that are stored, and ones that are lost at one level, at several and at all
    keys = np.unique([int(langid.grams(np.array([r.choice([langid.EDGE, *map(ord, "abcdefgq\u4e00")]) for _ in range(5)], np.uint16), 4)[-1]) for _ in range(1500)]).astype(np.uint64)
    asked = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key bigint")
    got = {row.key: row.logs for row in joined.find(asked).collect()}
    assert len(got) == len(keys) and joined.find(asked).count() == len(keys)
    assert np.allclose([got[int(k)] for k in keys.view(np.int64)], np.log(whole._probability(keys, 4)), rtol=1e-5)


def test_marks_belong_to_words_but_are_no_text(spark):
    assert langid.characters("\u0939\u093f\u0928\u094d\u0926\u0940").tolist() == [32, 0x939, 0x93F, 0x928, 0x94D, 0x926, 0x940, 32]
    assert langid.characters("\u0301 \u0302!").tolist() == [32]


def proto(*fields):
    """A protocol buffer message of (number, value): ints, floats, strings and messages."""
    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def unigram(bytes_=False, user=(), collapse=0, charsmap=b""):
    r = random.Random(8)
    found = {"".join(r.choice("abcde▁") for _ in range(n)) for n in (1, 1, 1, 1, 2, 2, 3, 3, 4, 5) for _ in range(12)} | {*"abcd▁"}
    own = [p for p in sorted(found) if "▁" not in p[1:] and p not in user and p != "e"]
    items = [proto((1, "<unk>"), (2, 0.0), (3, pieces.UNKNOWN)), proto((1, "<s>"), (2, 0.0), (3, pieces.CONTROL)), proto((1, "</s>"), (2, 0.0), (3, pieces.CONTROL))]
    items += [proto((1, p), (2, 0.0), (3, pieces.USER)) for p in user]
    items += [proto((1, f"<0x{i:02X}>"), (2, 0.0), (3, pieces.BYTE)) for i in range(256 if bytes_ else 0)]
    items += [proto((1, p), (2, -r.uniform(2, 9)), (3, pieces.NORMAL)) for p in own]
    trainer = proto((3, pieces.UNIGRAM), (35, int(bytes_)))
    norm = proto((1, "own"), *([(2, charsmap)] if charsmap else []), (3, 1), (4, collapse), (5, 1))
    return proto(*[(1, x) for x in items], (2, trainer), (3, norm))


#: "A" becomes "b", by a double array of five units: the root's offset is 1, "A"'s child holds the value.
def charsmap():
    units = [0] * 512
    units[0] = 1 << 10
    units[1 ^ 65] = 2 << 10 | 1 << 8 | 65
    units[1 ^ 65 ^ 2] = 0x80000000
    trie = struct.pack("<512I", *units)
    return struct.pack("<I", len(trie)) + trie + b"b\0"


@pytest.mark.parametrize("file", [unigram(), unigram(bytes_=True), unigram(user=("cab", "dd")), unigram(collapse=1), unigram(collapse=1, charsmap=charsmap())])
def test_unigram_ids_are_those_of_the_format(file):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=file)
    encoder = pieces.Encoder(pieces.Vocabulary.parse(file))
    r = random.Random(3)
    texts = ["".join(r.choice("aabbccddeA  xyé") for _ in range(r.randint(0, 40))) for _ in range(400)] + ["abcd" * 500 + "e" * 40, "dcab" * 30, "  ", ""]
    ids, counts, same = encoder.encode(texts)
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    expected = [library.encode(t) for t in texts]
    total = lambda x: sum(encoder.scores[i] if encoder.v.kinds[i] != pieces.UNKNOWN else 0.0 for i in x)
    # the library's running sums are of 32 bits, so that it may order pieces of one sum otherwise
    assert all(g == e or (sorted(g) == sorted(e) and total(g) == pytest.approx(total(e))) for g, e in zip(got, expected, strict=True))
    assert np.mean([g == e for g, e in zip(got[:400], expected[:400], strict=True)]) > 0.95
    assert all(encoder.decode(x) == t for x, t, ok in zip(got, texts, same, strict=True) if ok)


def test_text_without_spaces_is_as_fast_and_the_same():
    import time

    with open(pieces.DEFAULT_MODEL, "rb") as file:
        v = pieces.Vocabulary.parse(file.read())
    r = random.Random(2)
    encoder = pieces.Encoder(v)
    for alphabet in ("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/", "漢字仮名交文日本語中国"):
        text = "".join(r.choice(alphabet) for _ in range(40_000))
        began = time.time()
        ids = encoder.encode([text])[0]
        assert time.time() - began < 1.5 and encoder.decode(ids) == text
    word = "▁" + "".join(r.choice("thequickbrown") for _ in range(300))
    assert sum(v.scores[i] for i in encoder.words([word])[0]) == pytest.approx(brute_pieces(v, encoder.unknown, word))
