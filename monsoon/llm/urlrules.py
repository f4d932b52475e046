"""URL filtering by pattern rules, indexed by their rarest literal token.

A pattern is text in which * stands for any characters; ||name anchors a host and its subdomains, a leading | the start of
the URL.  A token is a run of letters and digits of the canonical URL (host in lower case, then path).  A pattern's safe
tokens are the runs in it that no * touches and that begin and end where a token of a URL must; its rarest one in the
corpus is its index key.  A URL's tokens fetch candidate rules, and only their regular expressions run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monsoon.llm.common import _col_of, map_batches

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans(_UPPER, _UPPER.lower())
_TOKEN = re.compile(r"[0-9A-Za-z]+")


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z lower-cased, and path; both empty without ://."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = re.split(r"[?#]", url[at + 3 :], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def tokens(host: str, path: str) -> set[str]:
    return set(_TOKEN.findall(host)) | set(_TOKEN.findall(path))


@dataclass(frozen=True)
class Rule:
    """Of the rules that match, the one of the highest priority gives the verdict (of equal ones, the first by name)."""

    name: str
    pattern: str
    verdict: str
    priority: int = 0

    @staticmethod
    def domain(host: str, path: str, verdict: str) -> Rule:
        """Fits the host and all subdomains where the path starts with path; the longest such rule wins."""
        return Rule(host + path, f"||{host}{path}*" if path else f"||{host}^*", verdict, len(host + path))

    def regex(self) -> re.Pattern[str]:
        body = self.pattern
        head = ""
        if body.startswith("||"):
            head, body = r"\A(?:[^/]*\.)?", body[2:]
        elif body.startswith("|"):
            head, body = r"\A", body[1:]
        parts = [".*".join(re.escape(x) for x in piece.split("*")) for piece in body.split("^")]
        return re.compile(head + r"(?=/|\Z)".join(parts), re.DOTALL)

    def safe_tokens(self) -> set[str]:
        body = self.pattern
        anchored = body.startswith("|")
        body = body.lstrip("|")
        out = set()
        for m in _TOKEN.finditer(body):
            left = anchored if m.start() == 0 else body[m.start() - 1] != "*"
            right = False if m.end() == len(body) else body[m.end()] != "*"
            if left and right:
                out.add(m[0])
        return out


def frequencies(urls: DataFrame, rules: list[Rule], url_col: str = "url") -> dict[str, int]:
    """In how many rows each safe token of the rules occurs; as many counts as the rules have tokens."""
    wanted = sorted({t for r in rules for t in r.safe_tokens()})
    if not wanted:
        return {}

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [t for url in batch.column(0).to_pylist() for t in tokens(*split_url(url)) if t in asked]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["token"])

    asked = frozenset(wanted)
    counts = map_batches(urls.select(_col_of(url_col).cast("string").alias("url")), run, "token string", 4096).groupBy("token").count()
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in counts.collect()}


class Index:
    """Rules by their rarest token; those without a safe token are candidates of every URL."""

    def __init__(self, rules: list[Rule], seen: dict[str, int]):
        self.by_token: dict[str, list[tuple[int, str, str, Rule]]] = {}
        self.always = []
        self.compiled: dict[Rule, re.Pattern[str]] = {}
        for rule in rules:
            entry = (-rule.priority, rule.name, rule.verdict, rule)
            safe = rule.safe_tokens()
            if safe:
                self.by_token.setdefault(min(safe, key=lambda t: (seen.get(t, 0), t)), []).append(entry)
            else:
                self.always.append(entry)

    def judge(self, host: str, path: str) -> tuple[str | None, str | None, int]:
        """The rule's name and verdict, None without one, and how many expressions ran."""
        candidates = list(self.always)
        if host or path:
            for token in tokens(host, path):
                candidates += self.by_token.get(token, ())
        canonical, tried = host + path, 0
        for _, name, verdict, rule in sorted(candidates, key=lambda x: x[:3]):
            tried += 1
            # compiled when first asked for
            if (pattern := self.compiled.get(rule)) is None:
                pattern = self.compiled[rule] = rule.regex()
            if pattern.search(canonical):
                return name, verdict, tried
        return None, None, tried


MAX_RULES = 2_000_000
#: The last index of a worker, with what it was built from, which tasks share.
_built: list[tuple[object, Index]] = []


def _index(value: tuple[list[Rule], dict[str, int]]) -> Index:
    if not _built or _built[0][0] is not value:
        _built[:] = [(value, Index(*value))]
    return _built[0][1]


def judge(spark: SparkSession, urls: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A row for each row of urls: id, host, path, rule (null without one), verdict (else default), tried (expressions run).

    A null URL or one without :// has an empty host and path, and the default verdict unless a rule without tokens fits.
    Repeated rows and null ids get rows of their own; other columns aren't read.  Rules are a list on the driver, of
    MAX_RULES at most, and go to the executors as one broadcast index.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    shared = spark.sparkContext.broadcast((rules, frequencies(urls, rules, url_col)))
    kind = urls.select(id_col).schema[0].dataType
    arrow = to_arrow_type(kind)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index = _index(shared.value)
        split = [split_url(u) for u in batch.column(1).to_pylist()]
        found = [index.judge(h, p) for h, p in split]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(arrow), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()), pa.array([n for n, _, _ in found], pa.string()), pa.array([v or default for _, v, _ in found], pa.string()), pa.array([t for _, _, t in found], pa.int32())],
            ["id", "host", "path", "rule", "verdict", "tried"],
        )

    plain = urls.select(_col_of(id_col).alias("id"), _col_of(url_col).cast("string").alias("url"))
    return map_batches(plain, run, f"id {kind.simpleString()}, host string, path string, rule string, verdict string, tried int", 4096)
