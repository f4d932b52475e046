"""Language identification by interpolated Kneser-Ney character models, one per language.

Text is lower-cased, runs of anything but letters and their marks become one boundary, and the order-n grams over what is
left (n = 4) are counted by language over the training texts.  A gram of four characters of 16 bits is a 64-bit key, so no
two grams share a key; letters beyond the basic plane share one character.  Continuation counts, discounts and the totals of
contexts are computed in Spark over all grams.  Keys are mixed by an odd factor and kept sorted, and a key's probability
under every language stands beside it, with the weight that its absence gives to the shorter gram.  Where these tables are
too large to broadcast they stay in Spark: the most frequent of the longest grams are broadcast, and what texts have of
others is looked up by joins, with the same results.

A text's score under a language is its cross-entropy a character.  The least wins.  A text is rejected where even that is
above a threshold, or where it has no letter.  The threshold is calibrated on the labelled texts of a fold (one in `folds`,
by a hash of the text) that the model hasn't learnt from: their median, and `spread` times as far above it as their
`quantile` lies, and 10 / n times further where there are only n of them, as so few say little of the tail.
"""

from __future__ import annotations

import unicodedata
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of, map_batches, rekey, trimmed

EDGE = 0x20
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BUCKET_BITS = 18


def _letters() -> np.ndarray:
    """Of each character of the basic plane, itself if it is a letter or mark, else EDGE."""
    table = np.full(65536, EDGE, np.uint16)
    for i in range(65536):
        c = chr(i)
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            table[i] = i
    return table


_LETTERS = _letters()
_ALPHA = np.array([chr(i).isalpha() for i in range(65536)])
_ASTRAL = 0xFFFF


def characters(text: str) -> np.ndarray:
    """The normalised characters of a text, with a boundary at either end; only a boundary if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    if points.size and points.max() > 65535:
        high = points > 65535
        out = _LETTERS[np.where(high, 0, points)]
        rare = np.flatnonzero(high)
        out[rare] = [_ASTRAL if chr(p).isalpha() else EDGE for p in points[rare]]
    else:
        out = _LETTERS[points]
    if not (_ALPHA[out] | (out == _ASTRAL)).any():
        out = out[:0]  # marks alone are no text
    out = np.concatenate((np.array([EDGE], np.uint16), out, np.array([EDGE], np.uint16)))
    gap = out == EDGE
    return out[~(gap & np.concatenate(([False], gap[:-1])))]


def grams(chars: np.ndarray, n: int) -> np.ndarray:
    """The key of the gram of n that ends at each character but the first boundary; it is padded by boundaries."""
    wide = np.concatenate((np.full(n - 2, EDGE, np.uint64), chars.astype(np.uint64)))
    size = len(chars) - 1
    key = np.zeros(size, np.uint64)
    for i in range(n):
        key = (key << np.uint64(16)) | wide[i : i + size]
    return key


@dataclass(frozen=True)
class LangId:
    """max_cells bounds what the broadcast model stores: if grams times languages are more, it has only the most frequent of the
    longest grams, and the others are joined (with a warning, as that takes longer)."""

    order: int = 4
    max_cells: int = 24_000_000
    folds: int = 10
    quantile: float = 0.99
    spread: float = 8.0
    min_chars: int = 20


class Table:
    """Sorted mixed keys with rows of values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        mixed = keys * _MULT
        order = np.argsort(mixed)
        self.keys, self.values = mixed[order], values[order]
        top = (self.keys >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        self.begin = np.searchsorted(top, np.arange((1 << _BUCKET_BITS) + 1)).astype(np.int32)
        self.depth = int(np.diff(self.begin).max()) if len(keys) else 0
        self.keys = np.concatenate((self.keys, np.zeros(self.depth + 1, np.uint64)))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, else -1."""
        mixed = keys * _MULT
        bucket = (mixed >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        at, stop = self.begin[bucket], self.begin[bucket + 1]
        out = np.full(len(keys), -1, np.int32)
        for _ in range(self.depth):
            hit = (self.keys[at] == mixed) & (at < stop)
            np.copyto(out, at, where=hit)
            at = at + 1
        return out


def _discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once else 0.5


class Model:
    """Built from arrays of (language index, key, count) of the longest grams, or by of_levels from Spark's statistics."""

    def __init__(self, languages: list[str], lang: np.ndarray, key: np.ndarray, count: np.ndarray, order: int):
        levels = [(lang, key, count.astype(np.float64))]
        for i in range(order - 1, 0, -1):  # continuation counts: in how many longer grams a gram is the end
            l, k, _ = levels[-1]
            short = k & np.uint64((1 << (16 * i)) - 1)
            pair = np.stack((l.astype(np.uint64), short), axis=1)
            found, n = np.unique(pair, axis=0, return_counts=True)
            levels.append((found[:, 0].astype(np.int64), found[:, 1], n.astype(np.float64)))
        levels.reverse()  # levels[i]: grams of i + 1
        shares = []
        for l, k, c in levels:
            discount = np.array([_discount(int((c[l == i] == 1).sum()), int((c[l == i] == 2).sum())) for i in range(len(languages))])
            context, of = np.unique(np.stack((l.astype(np.uint64), k >> np.uint64(16)), axis=1), axis=0, return_inverse=True)
            total = np.bincount(of, weights=c, minlength=len(context)) if len(c) else c
            shares.append((l, k, (c - discount[l]) / total[of] if len(c) else c))
        self._build(languages, shares, len(np.unique(levels[0][1])), order)

    @staticmethod
    def of_levels(languages: list[str], shares: list[tuple[np.ndarray, np.ndarray, np.ndarray]], alphabet: int, order: int) -> Model:
        """shares[i] has (language index, key, discounted share of the context's total) of grams of i + 1 characters."""
        model = Model.__new__(Model)
        model._build(languages, shares, alphabet, order)
        return model

    def __getstate__(self) -> dict:
        return self.__dict__ | {"shared": None}

    def _build(self, languages: list[str], shares: list[tuple[np.ndarray, np.ndarray, np.ndarray]], alphabet: int, order: int) -> None:
        self.languages, self.order, self.shared = languages, order, None
        n_lang = len(languages)
        self.floor = np.full(n_lang, 1.0 / (max(2, alphabet) + 1))
        self.tables: list[tuple[Table, Table]] = []
        for size, (l, k, share) in enumerate(shares, 1):
            keys, of = np.unique(k, return_inverse=True)
            own = np.zeros((len(keys), n_lang))
            own[of, l] = share
            context, ctx_of = np.unique(keys >> np.uint64(16), return_inverse=True)
            weight = np.ones((len(context), n_lang))
            # what the grams stored leave of the context's mass: their discounts, and all of those not stored
            np.subtract.at(weight, ctx_of, own)
            np.maximum(weight, 1e-12, out=weight)
            lower = self._probability(keys & np.uint64((1 << (16 * (size - 1))) - 1), size - 1)
            self.tables.append((Table(keys, own + weight[ctx_of] * lower), Table(context, weight)))

    def _probability(self, keys: np.ndarray, size: int) -> np.ndarray:
        """The probability of each gram's last character after the others, under every language."""
        if size == 0:
            return np.broadcast_to(self.floor, (len(keys), len(self.floor)))
        table, contexts = self.tables[size - 1]
        row = table.find(keys)
        out = table.values[row] if len(table.values) else np.zeros((len(keys), len(self.floor)))
        lost = np.flatnonzero(row < 0)
        if len(lost):
            at = contexts.find(keys[lost] >> np.uint64(16))
            weight = np.where((at >= 0)[:, None], contexts.values[at], 1.0) if len(contexts.values) else 1.0
            short = keys[lost] & np.uint64((1 << (16 * (size - 1))) - 1)
            out[lost] = weight * self._probability(short, size - 1)
        return out

    def freeze(self) -> Model:
        """Log-probabilities of the longest grams, for scoring."""
        table, _ = self.tables[-1]
        self.logs = np.log(table.values).astype(np.float32)
        return self

    def entropy(self, texts: list[str], missed: list[tuple[np.ndarray, np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The cross-entropy in nats a character of each text under each language, and each text's characters.

        With missed, longest grams that aren't in the table are left out and added there: indices of texts, and keys.
        """
        parts = [characters(t) for t in texts]
        sizes = np.array([len(p) - 1 for p in parts])
        out = np.zeros((len(texts), len(self.languages)))
        at = 0
        while at < len(texts):
            stop = at + 1
            while stop < len(texts) and sizes[at : stop + 1].sum() < 400_000:
                stop += 1
            out[at:stop] = self._sum(parts[at:stop], at, missed)
            at = stop
        return -out / np.maximum(sizes, 1)[:, None], sizes

    def _sum(self, parts: list[np.ndarray], first: int, missed: list[tuple[np.ndarray, np.ndarray]] | None) -> np.ndarray:
        out = np.zeros((len(parts), len(self.languages)))
        own = [(i, p[max(0, s - self.order) : s + 400_001], s) for i, p in enumerate(parts) if len(p) > 1 for s in range(0, len(p) - 1, 400_000)]
        keys, of = [], []
        for i, piece, s in own:
            key = grams(piece, self.order)
            key = key[min(s, self.order) if s else 0 :]  # characters before s only give context
            keys.append(key)
            of.append((i, len(key)))
        if not keys:
            return out
        flat = np.concatenate(keys)
        table, _ = self.tables[-1]
        row = table.find(flat)
        lost = np.flatnonzero(row < 0)
        logs = self.logs[row] if len(self.logs) else np.zeros((len(flat), len(self.languages)), np.float32)
        if len(lost) and missed is not None:
            logs[lost] = 0
            missed.append((np.repeat([first + i for i, _ in of], [n for _, n in of])[lost], flat[lost]))
        elif len(lost):
            logs[lost] = np.log(self._probability(flat[lost], self.order))
        ends = np.cumsum([n for _, n in of])
        sums = np.add.reduceat(logs.astype(np.float64), np.concatenate(([0], ends[:-1])), axis=0)
        for (i, _), row_sum in zip(of, sums, strict=True):
            out[i] += row_sum
        return out


def _low(key: Column, size: int) -> Column:
    """The key of a gram's last characters."""
    return key if size >= 4 else key.bitwiseAND(F.lit((1 << (16 * size)) - 1))


def _each(n: int, value) -> Column:
    """value(i) for each language, written out: a function over an array would be interpreted row by row."""
    return F.array(*[value(i) for i in range(n)])


def _times(n: int, a: str, b: str) -> Column:
    return _each(n, lambda i: F.get(a, F.lit(i)) * F.get(b, F.lit(i)))


def _logs(n: int, p: str) -> Column:
    return _each(n, lambda i: F.log(F.get(p, F.lit(i))).cast("float")).alias("logs")


class Joined(Model):
    """The same model with its tables in Spark: levels[i] has (key, n, p) of the grams of i + 1 characters and (context, weight), p
    and weight by language; the longest have logs, the logarithms of p.  Only those of frequent ones are in memory."""

    def __init__(self, languages: list[str], alphabet: int, order: int, shares: list[DataFrame], scratch: Scratch, max_cells: int):
        self.languages, self.order, self.shared, self.scratch = languages, order, None, scratch
        n_lang = len(languages)
        self.floor = 1.0 / (max(2, alphabet) + 1)
        own = [F.coalesce(F.sum(F.when(F.col("i") == j, F.col("share"))), F.lit(0.0)) for j in range(n_lang)]
        self.levels: list[tuple[DataFrame, DataFrame]] = []
        for size, share in enumerate(shares, 1):
            share = scratch.table(share, f"share-{size}")
            before = F.shiftrightunsigned("key", 16)
            # a row a gram and language is exchanged, since partial sums by language are wider and merge little
            weights = share.withColumn("context", before).repartition("context").groupBy("context").agg(F.array(*[F.greatest(1 - x, F.lit(1e-12)) for x in own]).alias("weight"))
            weights = scratch.table(weights, f"weights-{size}")
            grams = share.repartition("key").groupBy("key").agg(F.sum("n").alias("n"), F.array(*own).alias("own")).join(weights, before == F.col("context"))
            if size == 1:
                grams = grams.withColumn("lower", F.array_repeat(F.lit(self.floor), n_lang))
            else:
                # every gram's end is a gram of the level below
                grams = grams.join(self.levels[-1][0].select(F.col("key").alias("short"), F.col("p").alias("lower")), _low(F.col("key"), size - 1) == F.col("short"))
            grams = grams.select("key", "n", _each(n_lang, lambda i: F.get("own", F.lit(i)) + F.get("weight", F.lit(i)) * F.get("lower", F.lit(i))).alias("p"))
            grams = grams if size < order else grams.select("key", "n", _logs(n_lang, "p"))
            self.levels.append((scratch.table(grams, f"grams-{size}"), weights))
        last = self.levels[-1][0]
        power = F.floor(F.log2("n")).cast("int").alias("power")
        sizes = {r.power: r.k for r in last.groupBy(power).agg(F.count("*").alias("k")).collect()}  # 63 rows at most
        least = 0
        while n_lang * sum(k for p, k in sizes.items() if p >= least) > max_cells:
            least += 1
        often = last.where(F.col("n") >= F.lit(1 << least)).select("key", "logs").toArrow().combine_chunks()
        logs = often.column("logs").combine_chunks() if often.num_rows else None
        values = logs.flatten().to_numpy().reshape(-1, n_lang) if logs is not None else np.zeros((0, n_lang), np.float32)
        table = Table(often.column("key").to_numpy().view(np.uint64), values)
        self.tables, self.logs = [(table, None)], table.values

    def __getstate__(self) -> dict:
        return self.__dict__ | {"shared": None, "scratch": None, "levels": None}

    def find(self, keys: DataFrame) -> DataFrame:
        """key and logs of each of the longest grams in keys, which are distinct."""
        return self._stored(keys, self.order, "logs").unionByName(self._lost(keys, self.order).select("key", _logs(len(self.languages), "p")))

    def _stored(self, keys: DataFrame, size: int, value: str) -> DataFrame:
        own = self.levels[size - 1][0].select(F.col("key").alias("k"), value)
        return keys.join(own, F.col("key") == F.col("k")).select("key", value)

    def _lost(self, keys: DataFrame, size: int) -> DataFrame:
        """key and p of those keys that aren't in the table of their size; only their ends, once each, are looked up below."""
        table, contexts = self.levels[size - 1]
        lost = self.scratch.table(keys.join(table.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_anti"), f"lost-{size}")
        weight = F.coalesce("weight", F.array_repeat(F.lit(1.0), len(self.languages))).alias("weight")
        weighed = lost.join(contexts, F.shiftrightunsigned("key", 16) == F.col("context"), "left").select("key", weight)
        if size == 1:
            return weighed.select("key", _each(len(self.languages), lambda i: F.get("weight", F.lit(i)) * self.floor).alias("p"))
        ends = self.scratch.table(lost.select(_low(F.col("key"), size - 1).alias("key")).distinct(), f"ends-{size}")
        below = self._stored(ends, size - 1, "p").unionByName(self._lost(ends, size - 1)).select(F.col("key").alias("short"), F.col("p").alias("lower"))
        return weighed.join(below, _low(F.col("key"), size - 1) == F.col("short")).select("key", _times(len(self.languages), "weight", "lower").alias("p"))

    def _probability(self, keys: np.ndarray, size: int) -> np.ndarray:
        """For a few keys, on the driver."""
        asked, of = np.unique(keys, return_inverse=True)
        table = self.scratch.spark.createDataFrame(pa.table({"key": asked.view(np.int64)}))
        found = {r.key: r.logs for r in self.find(table).collect()}
        return np.exp(np.array([found[int(k)] for k in asked.view(np.int64)]))[of]


def _count(conf: LangId):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def merge(lang: str) -> None:
            """Adds what is held to the language's sorted keys and counts."""
            if not held.get(lang):
                return
            new = np.sort(np.concatenate(held.pop(lang)))
            start = np.flatnonzero(np.concatenate(([True], new[1:] != new[:-1])))
            key, n = new[start], np.diff(np.append(start, len(new)))
            if lang in counts:
                key = np.concatenate((counts[lang][0], key))
                n = np.concatenate((counts[lang][1], n))
                order = np.argsort(key, kind="stable")
                key, n = key[order], n[order]
                start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                key, n = key[start], np.add.reduceat(n, start)
            counts[lang] = key, n

        def out() -> Iterator[pa.RecordBatch]:
            for lang in list(counts):
                key, n = counts.pop(lang)
                for at in range(0, len(key), 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(key[at : at + 100_000]), pa.string()), pa.array(key[at : at + 100_000].view(np.int64)), pa.array(n[at : at + 100_000].astype(np.int64))],
                        ["lang", "key", "n"],
                    )

        waiting = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    chars = characters(text)
                    if len(chars) > 1:
                        held.setdefault(lang, []).append(grams(chars, conf.order))
                        waiting += len(chars)
                if waiting > 2_000_000:
                    for lang in list(held):
                        merge(lang)
                    waiting = 0
                    if sum(len(k) for k, _ in counts.values()) > 3_000_000:  # bounded memory, then a sum in Spark
                        yield from out()
        for lang in list(held):
            merge(lang)
        yield from out()

    return run


def _levels(scratch: Scratch, grams: DataFrame, order: int) -> list[DataFrame]:
    """(lang, key, n) of grams of 1 to order characters: counts of the longest, continuation counts of the others."""
    levels = [grams]
    for size in range(order - 1, 0, -1):
        short = levels[0].select("lang", F.col("key").bitwiseAND(F.lit((1 << (16 * size)) - 1)).alias("key"))
        levels.insert(0, scratch.table(short.groupBy("lang", "key").agg(F.count("*").alias("n")), f"level-{size}"))
    return levels


def _shares(levels: list[DataFrame], languages: list[str]) -> list[DataFrame]:
    """Language index, key, n and share, (n - discount) / total, of all grams by level."""
    spark, out = levels[0].sparkSession, []
    for level in levels:
        seen = {r.lang: r for r in level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()}
        number = [(lang, i, _discount(seen[lang].once, seen[lang].twice)) for i, lang in enumerate(languages)]
        of = spark.createDataFrame(number, "language string, i int, discount double")
        # a context has as many grams as the alphabet has letters at most
        total = F.sum("n").over(Window.partitionBy("lang", F.shiftrightunsigned("key", 16)))
        rows = level.withColumn("total", total).join(F.broadcast(of), F.col("lang") == F.col("language"))
        out.append(rows.select("i", "key", "n", ((F.col("n") - F.col("discount")) / F.col("total")).alias("share")))
    return out


def _arrays(share: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = share.select("i", "key", "share").toArrow()
    return table.column("i").to_numpy().astype(np.int64), table.column("key").to_numpy().view(np.uint64), table.column("share").to_numpy()


def _model(scratch: Scratch, levels: list[DataFrame], languages: list[str], conf: LangId) -> Model:
    alphabet, shares = levels[0].select("key").distinct().count(), _shares(levels, languages)
    if len(languages) * sum(level.count() for level in levels) <= conf.max_cells:
        return Model.of_levels(languages, [_arrays(s) for s in shares], alphabet, conf.order).freeze()
    warnings.warn(f"language models of more than {conf.max_cells} cells: rare grams are looked up by joins", stacklevel=3)
    return Joined(languages, alphabet, conf.order, shares, scratch, conf.max_cells)


def train(spark: SparkSession, labelled: DataFrame, conf: LangId | None = None, text_col: str = "text", lang_col: str = "lang") -> tuple[Model, float]:
    """The model of the labelled texts outside the calibration fold, and the rejection threshold in nats a character.

    Null texts or languages aren't learnt from.  Without any labelled text the model has no language and rejects all; with
    none in the calibration fold it rejects only texts without letters.
    """
    conf = conf or LangId()
    scratch = Scratch(spark, "langid")
    plain = labelled.select(_col_of(text_col).cast("string").alias("text"), _col_of(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    held = F.pmod(F.xxhash64("text"), F.lit(conf.folds)) == 0
    counted = plain.where(~held).mapInArrow(trimmed(_count(conf)), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    levels = _levels(scratch, scratch.table(counted, "grams"), conf.order)
    languages = sorted(r.lang for r in levels[0].select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), conf.order).freeze(), 0.0
    model = _model(scratch, levels, languages, conf)
    judged = predict(spark, plain.where(held), model, float("inf"), conf, "lang").where((F.col("id") == F.col("lang_pred")) & (F.col("n_chars") >= conf.min_chars))
    # in steps, so that the exact quantiles hold a few thousand counts however many texts there are
    steps = judged.select(F.round("cross_entropy", 3).alias("h")).agg(F.expr("percentile(h, array(0.5D, {}D))".format(conf.quantile)).alias("q"), F.count("*").alias("n")).first()
    if not steps.n:
        return model, float("inf")
    median, high = steps.q
    return model, median + conf.spread * (1 + 10 / steps.n) * (high - median)


_NAMES = ["id", "lang_pred", "score", "cross_entropy", "rejected", "n_chars", "text"]


def _judged(ids: pa.Array, texts: pa.Array, entropy: np.ndarray, size: np.ndarray, languages: list[str], threshold: float, conf: LangId) -> pa.RecordBatch:
    seen = (size > 0) & bool(languages)
    if languages:
        best = entropy.argmin(axis=1)
        least = entropy.min(axis=1)
        # the posterior at a fixed length, so that it doesn't saturate for long texts
        gap = np.exp(-(entropy - least[:, None]) * 10)
        score = 1 / gap.sum(axis=1)
    else:
        best = least = score = np.zeros(len(texts))
    rejected = ~seen | ((size >= conf.min_chars) & (least > threshold))
    lang = [languages[int(b)] if s else "und" for b, s in zip(best, seen, strict=True)]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(lang, pa.string()), pa.array(np.where(seen, score, 0.0)), pa.array(np.where(seen, least, 0.0)), pa.array(rejected), pa.array(size, pa.int64()), texts], _NAMES
    )


def _predict(shared, threshold: float, conf: LangId, kind: pa.DataType):
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        entropy, size = model.entropy([t or "" for t in batch.column(1).to_pylist()])
        yield _judged(batch.column(0).cast(kind), batch.column(1), entropy, size, model.languages, threshold, conf)

    return run


#: Missed grams of a text that are one row.
_CHUNK = 4096


def _partial(shared, kind: pa.DataType):
    """A row for each text with what its frequent grams give, and rows of the same number with its other grams."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        missed: list[tuple[np.ndarray, np.ndarray]] = []
        entropy, size = shared.value.entropy([t or "" for t in batch.column(2).to_pylist()], missed)
        names = ["row", "id", "text", "entropy", "size", "keys", "counts"]
        lists, n = pa.list_(pa.int64()), batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(kind), batch.column(2), pa.array(entropy.tolist(), pa.list_(pa.float64())), pa.array(size, pa.int64()), pa.nulls(n, lists), pa.nulls(n, lists)], names)
        if not missed:
            return
        text, key = (np.concatenate(x) for x in zip(*missed, strict=True))
        order = np.lexsort((key, text))
        text, key = text[order], key[order].view(np.int64)
        start = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (key[1:] != key[:-1]))))
        count = np.diff(np.append(start, len(text)))
        text, key = text[start], key[start]
        cuts = np.unique(np.concatenate((np.flatnonzero(np.diff(text, prepend=-1)), np.arange(0, len(text), _CHUNK)))).astype(np.int32)
        offsets = pa.array(np.append(cuts, len(text)), pa.int32())
        rows, n = batch.column(0).take(pa.array(text[cuts])), len(cuts)
        chunks = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (key, count)]
        yield pa.RecordBatch.from_arrays([rows, pa.nulls(n, kind), pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.float64())), pa.nulls(n, pa.int64()), *chunks], names)

    return run


def _predict_joined(plain: DataFrame, model: Joined, threshold: float, conf: LangId, kind) -> DataFrame:
    """The grams of all texts that aren't broadcast are made distinct, looked up, and their logarithms added up by row."""
    from pyspark.sql.pandas.types import to_arrow_type

    scratch, arrow, simple, n_lang = model.scratch, to_arrow_type(kind), kind.simpleString(), len(model.languages)
    numbered = plain.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    schema = f"row long, id {simple}, text string, entropy array<double>, size long, keys array<long>, counts array<long>"
    scored = scratch.table(map_batches(numbered, _partial(model.shared, arrow), schema, 128), "scored")
    missed = scored.where("keys is not null").select("row", F.explode(F.arrays_zip("keys", "counts")).alias("m")).select("row", F.col("m.keys").alias("key"), F.col("m.counts").alias("n"))
    known = scratch.table(model.find(scratch.table(missed.select("key").distinct(), "asked")), "rare")
    beside = missed.withColumn("k", rekey(F.col("key"))).join(known.select(rekey(F.col("key")).alias("k"), "logs"), "k")
    rest = beside.groupBy("row").agg(F.array(*[F.sum(F.col("n") * F.get("logs", F.lit(j)).cast("double")) for j in range(n_lang)]).alias("rest"))
    per = F.greatest(F.col("size"), F.lit(1))
    whole = F.when(F.col("rest").isNull(), F.col("entropy")).otherwise(F.zip_with("entropy", "rest", lambda h, x: h - x / per))
    judged = scored.where("entropy is not null").join(rest, "row", "left").select("id", "text", whole.alias("h"), "size").withColumn("least", F.array_min("h"))
    # as _judged does it, but here a text that nobody reads isn't exchanged
    seen, names = F.col("size") > 0, F.array(*[F.lit(x) for x in model.languages])
    score = 1 / F.aggregate(F.transform("h", lambda x: F.exp((F.col("least") - x) * 10)), F.lit(0.0), lambda x, y: x + y)
    return judged.select(
        "id", F.when(seen, F.get(names, F.array_position("h", F.col("least")).cast("int") - 1)).otherwise("und").alias("lang_pred"), F.when(seen, score).otherwise(0.0).alias("score"),
        F.when(seen, F.col("least")).otherwise(0.0).alias("cross_entropy"), (~seen | ((F.col("size") >= conf.min_chars) & (F.col("least") > threshold))).alias("rejected"), F.col("size").alias("n_chars"), "text",
    )


def predict(
    spark: SparkSession, docs: DataFrame, model: Model, threshold: float, conf: LangId | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row for each row of docs: id, lang_pred, score (0 to 1), cross_entropy, rejected, n_chars (normalised characters), text.

    Null texts and those without a letter are `und`, with score 0, and rejected.  Whole texts are scored.  Repeated rows and
    null ids get rows of their own.  The model is broadcast; max_cells bounds it (about 200 MB at most), and a larger one is
    joined.  id_col may be a struct, so that a caller can carry any columns along.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    conf = conf or LangId()
    kind = docs.select(id_col).schema[0].dataType
    plain = docs.select(_col_of(id_col).alias("id"), _col_of(text_col).cast("string").alias("text"))
    # the calibration's broadcast serves all later predictions
    if model.shared is None:
        model.shared = spark.sparkContext.broadcast(model)
    out = f"id {kind.simpleString()}, lang_pred string, score double, cross_entropy double, rejected boolean, n_chars long, text string"
    if isinstance(model, Joined):
        return _predict_joined(plain, model, threshold, conf, kind)
    return map_batches(plain, _predict(model.shared, threshold, conf, to_arrow_type(kind)), out, 128)


def held_out(id_column: Column) -> Column:
    """The test fold: crc32 of the id as text leaves 2 modulo 4; a null id is not in it."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
