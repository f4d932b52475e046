"""Benchmark decontamination by template windows; DataFrame functions only.

A text's tokens are names (runs of capitalised words, wherever they stand), numbers, units (unit words next after a
number) and words.  In its template the first three are typed placeholders.  Windows of `window` tokens of the benchmark
are hash-joined with those of the documents: a window with enough words by its template, one poor in words by its
template and values together, so mere agreement of placeholders is no match.  Windows that match along one alignment of
an item with a document must agree on their slots: one value of the item must stand for one value of the document
throughout, and windows with a value that stands for several don't count.  So a question with other names or numbers is
still caught.

Texts are read and tokenised once.  Windows are rows inside the scan's stage only: what leaves it are those that some item has, a
row a position.  A leak has one of the item's rarest windows, so windows that many items and documents share (an instruction
before every question) make no pairs; they are counted for the pairs that rarer ones have made.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, _col_of

UNITS = "km cm mm kg mg ml m g l s h min hours hour minutes minute seconds second days day weeks week months month years year miles mile meters metres grams liters litres dollars euros pounds cents percent degrees"
# possessive, as a loop that may be undone takes stack for each word of a long list
_CAPITAL = r"\p{Lu}\p{Ll}++(?![\p{L}\p{M}])"
TOKEN = rf"{_CAPITAL}(?: {_CAPITAL})*+|\p{{N}}++(?:[.,:]\p{{N}}++)*+|[\p{{L}}\p{{M}}]++"
#: Template codes of placeholders; a word's code is its hash.
NAME, NUMBER, UNIT = 1, 2, 3


@dataclass(frozen=True)
class Decontam:
    """A document leaks an item with min_share of whose windows it shares; a window with fewer than `literals` words must
    agree in its values too.  Benchmark windows are broadcast up to broadcast_rows, else joined by shuffle."""

    window: int = 8
    literals: int = 4
    min_share: float = 0.5
    broadcast_rows: int = 500_000


def tokens(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """keep, with arrays v (the hash of each token's lower-case value) and t (its code in the template)."""
    raw = df.select(*keep, F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)).alias("raw"))
    # no condition on the arrays here: it would be pushed below them and compute them again
    valued = raw.select(*keep, "raw", F.transform("raw", lambda x: F.xxhash64(F.lower(x))).alias("v"))

    def code(x: Column, i: Column) -> Column:
        after_number = F.when(i > 0, F.get("raw", i - 1).rlike(r"^\p{N}")).otherwise(False)
        word = F.get("v", i)
        lower = F.when(x.isin(*UNITS.split()) & after_number, F.lit(UNIT).cast("long")).otherwise(word)
        return (
            F.when((x >= "a") & (x < "{"), lower)
            .when(x.rlike(r"^\p{Lu}\p{Ll}+(?: |$)"), F.lit(NAME).cast("long"))
            .when(x.rlike(r"^\p{N}"), F.lit(NUMBER).cast("long"))
            .otherwise(word)
        )

    return valued.select(*keep, "v", F.transform("raw", code).alias("t"))


class _At:
    """The window of `size` tokens at column pos, from columns t and v.

    Hashes are over slices, whose code is a loop: written out token by token, two hashes and the slots make a method of a
    size that the JVM only interprets.
    """

    def __init__(self, size: int, literals: int):
        self.size = size
        self.tw, self.vw = (F.slice(c, F.col("pos") + 1, F.lit(size)) for c in ("t", "v"))
        words = reduce(add, [F.when(F.get("t", F.col("pos") + i).between(NAME, UNIT), 0).otherwise(1) for i in range(size)])
        self.poor = words < min(literals, size)

    def key(self, salt: int) -> Column:
        return _key(salt, self.poor, self.tw, self.vw)


def _key(salt: int, poor: Column, tw: Column, vw: Column) -> Column:
    return F.when(poor, F.xxhash64(F.lit(-salt), vw)).otherwise(F.xxhash64(F.lit(salt), tw))


def _slots(tw: Column, vw: Column) -> Column:
    """The value of each placeholder, null where a word stands."""
    return F.zip_with(tw, vw, lambda t, v: F.when(t.between(NAME, UNIT), v))


def _positions(df: DataFrame, keep: list[str], size: int) -> DataFrame:
    """A row for each position at which a window of size begins."""
    starts = F.slice("t", F.lit(1), F.greatest(F.size("t") - (size - 1), F.lit(0)))
    return df.select(*keep, "t", "v", F.posexplode(starts).alias("pos", "_t0"))


def _benchmark(items: DataFrame, sizes: list[int], conf: Decontam) -> DataFrame:
    parts = []
    for size in sizes:
        at, own = _At(size, conf.literals), items.where(F.col("size") == size)
        parts.append(
            _positions(own, ["item", "idig"], size).select(
                "item", "idig", F.lit(size).alias("size"), F.col("pos").alias("ipos"), at.poor.alias("poor"), at.key(1).alias("a"), at.key(2).alias("b"), _slots(at.tw, at.vw).alias("islots")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _seen(docs: DataFrame, keys: DataFrame, sizes: list[int], conf: Decontam, small: bool) -> DataFrame:
    """Windows of docs that some item has: a row a position and size at most, however many items share a window."""
    ats = {size: _At(size, conf.literals) for size in sizes}
    least = min(sizes)
    at_pos = _positions(docs, ["id", "digest"], least)

    def of_size(value) -> Column:
        """value(window) for the size in column size; null where the text ends before."""
        if len(sizes) == 1:
            return value(ats[least])
        return F.coalesce(*[F.when(F.col("size") == size, value(at)) for size, at in ats.items()])

    if len(sizes) > 1:
        ends = F.array(*[F.when(F.col("pos") + size <= F.size("t"), F.lit(size)) for size in sizes])
        at_pos = at_pos.select("id", "digest", "t", "v", "pos", F.explode(ends).alias("size")).where("size is not null")
    else:
        at_pos = at_pos.withColumn("size", F.lit(least))
    window = [of_size(lambda at: at.tw).alias("tw"), of_size(lambda at: at.vw).alias("vw")]
    keyed = at_pos.withColumn("k", of_size(lambda at: at.key(1)))
    keys = F.broadcast(keys) if small else keys
    if small:
        # only windows whose hash is in the index are written out
        found = keyed.join(keys, (F.col("k") == F.col("a")) & (F.col("size") == F.col("ksize"))).withColumns({"tw": window[0], "vw": window[1]})
    else:
        found = keyed.select("id", "digest", "pos", "size", "k", *window).join(keys, (F.col("k") == F.col("a")) & (F.col("size") == F.col("ksize")))
    return found.select("id", "digest", "pos", "size", F.col("k").alias("a"), "tw", "vw")


def _rare(own: DataFrame, conf: Decontam) -> DataFrame:
    """The windows of each item of which a leak must have one: of its n windows with enough words, and of all of them, all but the
    ceil(min_share * n) - 1 that most items share, since that many fewer than min_share are no leak."""
    spread = own.groupBy("size", "a").agg(F.count("*").alias("shared"))
    known = own.select("item", "idig", "size", "a", "poor", "ipos").join(spread, ["size", "a"])
    # an item's windows, as many as its tokens; equal keys in any order
    order = lambda *by: Window.partitionBy(*by).orderBy("shared", "a", "ipos")
    whole = lambda *by: F.count("*").over(Window.partitionBy(*by))
    need = lambda n: n - F.ceil(conf.min_share * n) + 1
    item = ["item", "idig"]
    kept = known.withColumns({
        "rich_at": F.row_number().over(order(*item, "poor")), "rich_n": whole(*item, "poor"), "all_at": F.row_number().over(order(*item)), "all_n": whole(*item),
    }).where((~F.col("poor") & (F.col("rich_at") <= need(F.col("rich_n")))) | (F.col("all_at") <= need(F.col("all_n"))))
    return kept.select(*item, "size", "a").distinct()


def leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    conf: Decontam | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row for each document and item that it leaks: id, digest (xxhash64 of the text), item, matched, total, share.

    matched counts the item's windows found along alignments with consistent slots, total all of its windows: those with
    enough words where min_share of these is found, else all.  An item of fewer tokens than `window` is one window of its
    own size.  A token is at most a run of letters, so a text without spaces is matched by whole runs.  Null and empty
    texts have no window.  Rows that repeat an id and a text give one row; items with the same text are each reported; a
    null id or item is reported as null.  Empty tables give no rows.  Other columns aren't read, so their names may clash
    with anything.
    """
    conf = conf or Decontam()
    scratch = Scratch(spark, "decontam")
    items = benchmark.select(_col_of(item_col).alias("item"), _col_of(item_text_col).cast("string").alias("text")).where("text is not null").distinct()
    items = tokens(items.withColumn("idig", F.xxhash64("text")), ["item", "idig"])
    items = scratch.table(items.withColumn("size", F.least(F.size("t"), F.lit(conf.window))), "items")
    sizes = sorted(r.size for r in items.select("size").distinct().collect() if r.size > 0)  # at most `window` values
    plain = docs.select(_col_of(id_col).alias("id"), _col_of(text_col).cast("string").alias("text")).where("text is not null")
    if not sizes:
        kinds = plain.schema["id"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
        return spark.createDataFrame([], "id {}, digest long, item {}, matched long, total long, share double".format(*kinds))
    own = scratch.table(_benchmark(items, sizes, conf), "benchmark")
    small = own.count() <= conf.broadcast_rows
    keys = own.select("a", F.col("size").alias("ksize")).distinct()
    seen = scratch.table(_seen(tokens(plain.withColumn("digest", F.xxhash64("text")), ["id", "digest"]), keys, sizes, conf, small), "seen")

    # a document and an item that can leak share one of the item's rarest windows; only such pairs have all their windows counted
    rare = scratch.table(_rare(own, conf), "rare")
    held = seen.select("id", "digest", "size", "a").distinct()
    pairs = held.join(F.broadcast(rare) if small else rare, ["size", "a"]).select(*[F.col(c).alias(f"p_{c}") for c in ("id", "digest", "item", "idig")]).distinct()
    spots = seen.join(scratch.table(pairs, "pairs"), F.col("id").eqNullSafe(F.col("p_id")) & (F.col("digest") == F.col("p_digest")))
    mine = own.select(*[F.col(c).alias(f"i_{c}") for c in own.columns])
    same_window = (F.col("a") == F.col("i_a")) & (F.col("size") == F.col("i_size")) & F.col("p_item").eqNullSafe(F.col("i_item")) & (F.col("p_idig") == F.col("i_idig"))
    hits = spots.join(F.broadcast(mine) if small else mine, same_window).select(
        "id", "digest", F.col("p_item").alias("item"), F.col("p_idig").alias("idig"), (F.col("pos") - F.col("i_ipos")).alias("shift"), F.col("i_ipos").alias("ipos"), F.col("i_poor").alias("poor"), F.col("i_b").alias("b"),
        F.col("i_islots").alias("islots"), "tw", "vw",
    )

    # one exchange: a document's windows of an item meet, which are as many as its tokens at most
    pair = ["id", "digest", "item", "idig"]
    dealt = hits.repartition(*pair)
    slots = F.filter(F.arrays_zip("islots", _slots(F.col("tw"), F.col("vw")).alias("slots")), lambda s: s.islots.isNotNull())
    # the second hash, of what the first has found
    other = _key(2, F.col("poor"), F.col("tw"), F.col("vw")) != F.col("b")
    spots = dealt.select(*pair, "shift", "ipos", "poor", other.alias("other"), F.explode_outer(slots).alias("s"))
    same = Window.partitionBy(*pair, "shift", "s.islots")
    broken = F.col("other") | (F.col("s").isNotNull() & (F.min("s.slots").over(same) != F.max("s.slots").over(same)))
    right = spots.withColumn("broken", broken).groupBy(*pair, "shift", "ipos", "poor").agg(F.bool_or("broken").alias("broken")).where("not broken")
    counted = right.select(*pair, "ipos", "poor").distinct().groupBy(*pair).agg(F.count_if(~F.col("poor")).alias("r"), F.count("*").alias("n"))

    totals = own.groupBy("item", "idig").agg(F.count_if(~F.col("poor")).alias("rich"), F.count("*").alias("total")).withColumnsRenamed({"item": "i_", "idig": "d_"})
    judged = counted.join(F.broadcast(totals) if small else totals, F.col("item").eqNullSafe(F.col("i_")) & (F.col("idig") == F.col("d_")))
    rich = (F.col("rich") > 0) & (F.col("r") >= conf.min_share * F.col("rich"))
    judged = judged.where(rich | (F.col("n") >= conf.min_share * F.col("total")))
    judged = judged.select(*pair[:3], F.when(rich, F.col("r")).otherwise(F.col("n")).alias("matched"), F.when(rich, F.col("rich")).otherwise(F.col("total")).alias("total"))
    return judged.withColumn("share", F.col("matched") / F.col("total"))
