"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds what they don't reach.

Base spans come from fixed patterns with checks.  The field works on islands of atoms (runs of letters and digits, or single
signs) around digits and @.  Every span of atoms outside the base spans is a candidate segment of each kind that can have
its length (LONGEST characters: what an address, written with its separators, or a number of 19 digits can take); features
of the whole span (its shape, digit groups, check digit, balance of brackets, what stands around it) score it, an atom
outside scores 0, and dynamic programming over end positions chooses boundaries and kinds together.  Weights are those of the
greatest conditional likelihood on sentences made from templates (`examples`, a fixed seed), trained on the driver.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from monsoon.llm.common import _col_of, map_batches

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# where a run of digits begins no match, none begins inside it, and matches end with a run: only starts of runs are tried
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, leftmost and non-overlapping, from one @ to the next."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[Span]:
    """By kind, then start; a match that fails its check is dropped and its text isn't tried again."""
    if not text:
        return []
    out = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_small(x) for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


# ---- the field

_ATOM = re.compile(r"[^\W_]+|[^\w\s]|_")
_CUES = {
    "email": {"email", "mail", "contact", "write", "e"},
    "ip": {"ip", "host", "server", "address", "addr", "from"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "cc"},
    "phone": {"phone", "tel", "telephone", "call", "fax", "mobile", "cell", "contact"},
}
_DOTS = {"dot"}
_ATS = {"at"}
#: Characters that a span can have: an address has 254 at most, twice that with [dot] for each dot; others are numbers.
LONGEST = {"email": 508, "ip": 64, "card": 64, "phone": 64}
_JOINTS = _DOTS | _ATS | set("[](){}")


@dataclass(frozen=True)
class Atom:
    text: str
    start: int
    end: int


def atoms(text: str, start: int, end: int) -> list[Atom]:
    return [Atom(m[0], m.start(), m.end()) for m in _ATOM.finditer(text, start, end)]


_GROUP = re.compile("[0-9]+")


def features(text: str, span: list[Atom], before: list[str], after: str, kind: str, following: tuple[str, ...] = ()) -> list[str] | None:
    """Names of what holds for a whole span as one of kind; None if it can't be one.  following are the next atoms."""
    start, end = span[0].start, span[-1].end
    surface = text[start:end]
    words = [a.text for a in span]
    out = [f"{kind}|bias"]
    if kind == "email":
        at = [i for i, w in enumerate(words) if w == "@" or w.lower() in _ATS]
        dots = any(w == "." or w.lower() in _DOTS for w in words[at[0] + 1 :]) if at else False
        if len(at) != 1 or not 0 < at[0] < len(words) - 1 or not dots or not words[0].isalnum() or not words[-1].isalpha() or len(words[-1]) < 2 or words[-1].lower() in _DOTS | _ATS:
            return None
        spelled = "@" not in surface
        if spelled and not any(w.lower() in _DOTS for w in words):
            return None
        odd = sum(not (w.isalnum() or w in "@.-_+[](){}") for w in words)
        gaps = sum(b.start > a.end for a, b in zip(span, span[1:], strict=False))
        if spelled:
            loose = sum(1 for i, (a, b) in enumerate(zip(span, span[1:], strict=False)) if b.start > a.end and not ({words[i].lower(), words[i + 1].lower()} & _JOINTS))
        else:
            loose = gaps
        if (spelled and loose) or loose > 2:
            return None
        out += [f"email|spelled{spelled}", f"email|spelled{spelled}brackets{'[' in surface or '(' in surface}", f"email|odd{min(odd, 2)}", f"email|loose{min(loose, 2)}", f"email|tld{min(len(words[-1]), 5)}", f"email|more{spelled}{any(w.lower() in _DOTS for w in following)}"]
    else:
        if any(not (w.isdigit() and w.isascii()) and w not in "+()-. /" for w in words) or not ("0" <= surface[-1] <= "9") or surface[0] not in "+(0123456789":
            return None
        groups = _GROUP.findall(surface)
        digits = "".join(groups)
        shape = "-".join(str(len(g)) for g in groups) if len(groups) < 6 else "many"
        signs = {w for w in words if not w.isdigit()}
        spaced = any(b.start > a.end for a, b in zip(span, span[1:], strict=False))
        if kind == "ip":
            if len(groups) != 4 or signs != {"."} or spaced or not all(_small(g) for g in groups):
                return None
            out.append(f"ip|long{sum(len(g) > 1 for g in groups) > 1}")
        elif kind == "card":
            if not 13 <= len(digits) <= 19 or not signs <= {"-"}:
                return None
            out += [f"card|luhn{luhn(digits)}", f"card|n{len(digits)}", f"card|even{len(set(map(len, groups[:-1]))) < 2}", f"card|one{len(groups) == 1}"]
        else:
            if not 7 <= len(digits) <= 15 or "/" in signs:
                return None
            out += [f"phone|n{len(digits)}", f"phone|shape{shape}", f"phone|plus{surface[0] == '+'}", f"phone|brackets{surface.count('(')}{surface.count('(') == surface.count(')')}", f"phone|one{len(groups) == 1}", f"phone|dots{'.' in signs}"]
    left = text[start - 1] if start else " "
    out += [f"{kind}|left{_class(left)}", f"{kind}|right{_class(after)}"]
    if any(w.lower() in _CUES[kind] for w in before):
        out.append(f"{kind}|cue")
    return out


def _class(c: str) -> str:
    return "a" if c.isalnum() else "s" if c.isspace() else c if c in "@.-+/$#:(" else "p"


_SHAPE = str.maketrans("123456789", "000000000")


@dataclass
class Crf:
    examples: int = 400
    epochs: int = 12
    weights: dict[str, float] = field(default_factory=dict)
    scores: dict[tuple, float | None] = field(default_factory=dict, repr=False)

    def candidates(self, island: list[Atom], free: list[bool]) -> Iterator[tuple[int, int, str]]:
        """(first atom, end atom, kind) of the spans of free atoms that have the length and signs of a kind."""
        words = [a.text.lower() for a in island]
        is_at = [w == "@" or w in _ATS for w in words]
        next_at = [len(island)] * (len(island) + 1)
        for i in range(len(island) - 1, -1, -1):
            next_at[i] = i if is_at[i] else next_at[i + 1]
        number = [w.isdigit() and w.isascii() for w in words]
        for i, first in enumerate(words):
            if not free[i]:
                continue
            if number[i] or first in "+(":
                digits = groups = 0
                for j in range(i, len(island)):
                    if not free[j] or not (number[j] or words[j] in "+()-. /") or island[j].end - island[i].start > LONGEST["card"]:
                        break
                    if number[j]:
                        digits, groups = digits + len(words[j]), groups + 1
                        if digits > 19:
                            break
                        if groups == 4 and digits <= 12:
                            yield i, j + 1, "ip"
                        if digits >= 13:
                            yield i, j + 1, "card"
                        if 7 <= digits <= 15:
                            yield i, j + 1, "phone"
            if first.isalnum() and next_at[i] < len(island) and island[next_at[i]].end - island[i].start <= LONGEST["email"]:
                ats = gaps = 0
                for j in range(i, len(island)):
                    if not free[j] or island[j].end - island[i].start > LONGEST["email"]:
                        break
                    ats += is_at[j]
                    gaps += j > i and island[j].start > island[j - 1].end and words[j] not in _JOINTS and words[j - 1] not in _JOINTS
                    if ats > 1 or gaps > 2:
                        break
                    if ats and words[j].isalpha() and len(words[j]) > 1:
                        yield i, j + 1, "email"

    def _around(self, text: str, island: list[Atom], i: int, j: int, limit: int) -> tuple[list[str], str, tuple[str, ...]]:
        """The words before, the next character and the next two atoms."""
        end = island[j - 1].end
        return [a.text for a in island[max(0, i - 3) : i]], text[end] if end < limit else " ", tuple(a.text for a in island[j : j + 2])

    def segments(self, text: str, island: list[Atom], limit: int, free: list[bool] | None = None) -> list[tuple[int, int, str, list[str]]]:
        """(first atom, end atom, kind, features) of all candidates that can be of their kind."""
        out = []
        for i, j, kind in self.candidates(island, free or [True] * len(island)):
            before, after, following = self._around(text, island, i, j, limit)
            found = features(text, island[i:j], before, after, kind, following)
            if found:
                out.append((i, j, kind, found))
        return out

    def score(self, text: str, island: list[Atom], i: int, j: int, kind: str) -> float | None:
        """The sum of its features' weights, None if it can't be of the kind.

        Features of cards and phones don't depend on digits but for the check digit, so they are remembered by shape.
        """
        before, after, following = self._around(text, island, i, j, len(text))
        start, end = island[i].start, island[j - 1].end
        key = None
        if kind in ("card", "phone"):
            surface = text[start:end]
            cue = any(w.lower() in _CUES[kind] for w in before)
            check = kind == "card" and luhn("".join(c for c in surface if c in "0123456789"))
            key = kind, surface.translate(_SHAPE), text[start - 1] if start else " ", after, cue, check
            if key in self.scores:
                return self.scores[key]
        found = features(text, island[i:j], before, after, kind, following)
        value = sum(self.weights.get(f, 0.0) for f in found) if found else None
        if key:
            if len(self.scores) > 200_000:
                self.scores.clear()
            self.scores[key] = value
        return value

    def best(self, text: str, island: list[Atom], taken: list[tuple[int, int]] | None = None) -> list[Span]:
        """The segmentation of the highest score, of spans that overlap none of taken (sorted)."""
        free, at = [], 0
        for a in island:
            while taken and at < len(taken) and taken[at][1] <= a.start:
                at += 1
            free.append(not taken or at == len(taken) or taken[at][0] >= a.end)
        ends: dict[int, list[tuple[float, int, str]]] = {}
        for i, j, kind in self.candidates(island, free):
            score = self.score(text, island, i, j, kind)
            if score is not None and score > 0:
                ends.setdefault(j, []).append((score, i, kind))
        if not ends:
            return []
        top, back = [0.0] * (len(island) + 1), [None] * (len(island) + 1)
        for j in range(1, len(island) + 1):
            top[j] = top[j - 1]
            for score, i, kind in ends.get(j, ()):
                if top[i] + score > top[j]:
                    top[j], back[j] = top[i] + score, (i, kind)
        out, j = [], len(island)
        while j > 0:
            if back[j] is None:
                j -= 1
                continue
            i, kind = back[j]
            out.append((kind, island[i].start, island[j - 1].end))
            j = i
        return out[::-1]

    def fit(self, seed: int = 5) -> Crf:
        """Gradient ascent on the conditional log-likelihood of the true segments."""
        names: dict[str, int] = {}
        data = []
        for text, truth in _examples(self.examples, random.Random(seed)):
            island = atoms(text, 0, len(text))
            segments = [(i, j, [names.setdefault(f, len(names)) for f in found], (kind, island[i].start, island[j - 1].end) in truth) for i, j, kind, found in self.segments(text, island, len(text))]
            if segments:
                data.append((len(island), segments))
        w, g2 = np.zeros(len(names)), np.full(len(names), 1e-6)
        for _ in range(self.epochs):
            for n, segments in data:
                score = [float(w[f].sum()) for _, _, f, _ in segments]
                a, b = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
                a[0] = b[n] = 0.0
                by_end, by_start = {}, {}
                for s, (i, j, _, _) in zip(score, segments, strict=True):
                    by_end.setdefault(j, []).append((i, s))
                    by_start.setdefault(i, []).append((j, s))
                for j in range(1, n + 1):
                    a[j] = _logsum([a[j - 1], *(a[i] + s for i, s in by_end.get(j, ()))])
                for i in range(n - 1, -1, -1):
                    b[i] = _logsum([b[i + 1], *(b[j] + s for j, s in by_start.get(i, ()))])
                grad: dict[int, float] = {}
                for s, (i, j, f, true) in zip(score, segments, strict=True):
                    d = true - math.exp(a[i] + s + b[j] - a[n])
                    if abs(d) > 1e-6:
                        for x in f:
                            grad[x] = grad.get(x, 0.0) + d
                for x, d in grad.items():
                    d -= 1e-3 * w[x]
                    g2[x] += d * d
                    w[x] += 0.5 * d / math.sqrt(g2[x])
        self.weights = {f: float(w[i]) for f, i in names.items()}
        return self


def _logsum(xs: list[float]) -> float:
    top = max(xs)
    return top if top == -math.inf else top + math.log(sum(math.exp(x - top) for x in xs))


def _examples(n: int, r: random.Random) -> Iterator[tuple[str, set[Span]]]:
    """Sentences with personal data in usual and unusual forms, and with numbers that are none."""
    syllables = "ba co du el fi gor hum in jel ka lo mar nev ost pri qua ren sol tur ver".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card() -> str:
        body = digits(15)
        body += next(c for c in "0123456789" if luhn(body + c))
        return r.choice([body, " ".join(body[i : i + 4] for i in range(0, 16, 4)), "-".join(body[i : i + 4] for i in range(0, 16, 4))])

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{digits(2)} {a} {b}{c}", f"{a}.{b}.{c}", f"+{digits(2)}{a}{b}{c}"])

    def email() -> str:
        host = r.choice(["com", "org", "net", "de"])
        return r.choice([f"{word()}@{word()}.{host}", f"{word()}.{word()}@{word()}.{word()}.{host}", f"{word()} [at] {word()} [dot] {host}", f"{word()} at {word()} dot {host}", f"{word()}(at){word()}(dot){host}", f"{word()} [dot] {word()} [at] {word()} [dot] {word()} [dot] {host}", f"{word()} dot {word()} at {word()} dot {host}", f"{word()}{digits(2)}@{word()}.{host}"])

    def ip() -> str:
        return ".".join(str(r.randint(0, 255)) for _ in range(4))

    def none() -> str:
        return r.choice([
            f"{r.randint(0, 12)}.{r.randint(0, 9)}", f"20{digits(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", f"${r.randint(1, 999)},{digits(3)}.{digits(2)}", f"#{digits(8)}", digits(r.randint(1, 7)), digits(10), digits(16), digits(12),
            "".join(r.choice("0123456789abcdef") for _ in range(40)), f"{r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 9)}", f"{digits(3)} {digits(3)} {digits(3)}", f"{digits(4)}-{digits(4)}", f"{r.randint(1, 30)}/{r.randint(1, 12)}/20{digits(2)}", f"{digits(3)}-{digits(2)}-{digits(4)}", f"@{word()}", f"{word()} at {word()} {word()}", f"{word()} at {word()} dot {word()}{word()}", f"{digits(2)}.{digits(6)}, {digits(2)}.{digits(6)}", f"{digits(1)} {digits(4)} {digits(4)} {digits(4)}", f"ISBN 978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}", digits(20), digits(13),
        ])

    makers = {"card": card, "phone": phone, "email": email, "ip": ip}
    for _ in range(n):
        text, truth = "", set()
        for _ in range(r.randint(1, 3)):
            text += " ".join(word() for _ in range(r.randint(1, 4))) + " "
            if r.random() < 0.5:
                kind = r.choice(list(makers))
                if r.random() < 0.3:
                    text += r.choice(sorted(_CUES[kind] - {"e"})) + r.choice([": ", " "])
                value = makers[kind]()
                truth.add((kind, len(text), len(text) + len(value)))
            else:
                value = none()
            text += value + r.choice(["", "", ".", ",", "!!", "###"]) + " "
        yield text + word(), truth


@lru_cache(2)
def trained(examples: int = 400, epochs: int = 12) -> Crf:
    return Crf(examples=examples, epochs=epochs).fit()


_ANCHOR = re.compile(r"[0-9]|@|\b[Aa][Tt]\b(?=.{1,%d}\b[Dd][Oo][Tt]\b)" % LONGEST["email"])


def added_spans(text: str, crf: Crf, base: list[Span]) -> list[Span]:
    """Spans of the field, which decodes what the base spans leave free."""
    out: list[Span] = []
    begin = end = -1
    islands = []
    for m in _ANCHOR.finditer(text):
        reach = LONGEST["phone" if m[0].isdigit() else "email"]
        start = max(0, m.start() - reach)
        # back to where an atom starts, so that nothing before the anchor is lost, also without white space
        while start > max(end, 0) and text[start - 1].isalnum() and text[start].isalnum():
            start -= 1
        if end < 0 or start > end:
            if end >= 0:
                islands.append((begin, end))
            begin, end = start, 0
        else:
            # an anchor of a longer reach may begin before those that it joins
            while start < begin and islands and islands[-1][1] >= start:
                begin = islands.pop()[0]
            begin = min(begin, max(start, islands[-1][1] if islands else 0))
        end = max(end, min(len(text), m.end() + reach))
    if end >= 0:
        islands.append((begin, end))
    taken: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        # spans of different kinds may overlap
        if taken and s <= taken[-1][1]:
            taken[-1] = taken[-1][0], max(e, taken[-1][1])
        else:
            taken.append((s, e))
    at = 0
    for begin, end in islands:
        while at < len(taken) and taken[at][1] <= begin:
            at += 1
        stop = at
        while stop < len(taken) and taken[stop][0] < end:
            stop += 1
        out += crf.best(text, atoms(text, begin, end), taken[at:stop])
    return out


def _key(span: Span) -> tuple[int, int, int]:
    return KINDS.index(span[0]), span[1], span[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(set(spans), key=_key))


def find(spark: SparkSession, docs: DataFrame, crf: Crf | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: id, base and spans (arrays of kind, start, end in code points, end exclusive).

    base has the pattern's spans, spans also those the field adds; both by kind, then start.  Null and empty texts have
    none.  Whole texts are searched, of any length.  Repeated rows and null ids get rows of their own.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    shared = spark.sparkContext.broadcast(crf or trained())
    kind = docs.select(id_col).schema[0].dataType
    arrow = to_arrow_type(kind)
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        base, spans = [], []
        for text in batch.column(1).to_pylist():
            own = base_spans(text)
            more = added_spans(text, shared.value, own) if text else []
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in sorted(set(x), key=_key)] for x in (own, own + more)]
            base.append(rows[0])
            spans.append(rows[1])
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow), pa.array(base, pa.list_(item)), pa.array(spans, pa.list_(item))], ["id", "base", "spans"])

    plain = docs.select(_col_of(id_col).alias("id"), _col_of(text_col).cast("string").alias("text"))
    of = "array<struct<kind: string, start: int, end: int>>"
    return map_batches(plain, run, f"id {kind.simpleString()}, base {of}, spans {of}", 256)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans, the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
    return "".join([*out, text[at:]])


def base_sha256(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
