"""Personal data by a semi-Markov conditional random field over whole spans.

Base spans come from the exact definitions of the four kinds and always stay. The
semi-Markov field then reads what they leave: a *region* is a run of neighbouring
chunks (texts between white space, base spans and ``, ; = " |``) that hold a digit or an ``@``. A segmentation of a
region cuts it into entities of at most ``MAX_CHUNKS`` chunks and single chunks
outside; its score is the sum over segments of weights of whole-span features (digit
groups, separators, brackets, checksum, letters, preceding word) plus transitions.
Bounded-entity dynamic programming over the whole region, however long, finds the best
segmentation, boundaries and kinds jointly; its entities that touch no base span are added.

Training, in numpy-free Python on the driver, maximises the conditional likelihood
(segmental forward-backward, AdaGrad) over regions of at most ``TRAIN_TEXTS`` short
texts picked by hash among those that hold candidate characters. Base spans are the
known entities. Each is also presented in written variants (a phone number without its
country code, an e-mail address with a bracketed at, a card number with dots, an ip
with bracketed dots), so the field learns forms that the definitions miss; ``ORDINARY`` sentences of
ordinary numbers (thousands, decimals, dates, versions, book numbers, tables) teach it what
to leave alone. Regions of more than ``TRAIN_CHUNKS`` chunks are not trained on.

Scanning is one pass of ``mapInArrow`` with the broadcast weights (bounded by the
feature set). Spans are code points, end exclusive.

Defined results: null and empty texts have no spans. Rows are read one by one:
repeated rows repeat their result, extra columns are ignored, empty tables give empty
results. Without training regions the field adds nothing.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")
#: The definitions of the base spans.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

MAX_CHUNKS = 5
TRAIN_TEXTS, TRAIN_CHARS, TRAIN_CHUNKS, ORDINARY, EPOCHS, RATE = 300, 8000, 40, 600, 8, 0.5
OUTSIDE = "-"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def _octets(s: str) -> bool:
    return all(len(n) <= 3 and int(n or "0") <= 255 for n in (p.lstrip("0") for p in s.split(".")))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses in linear time: from each ``@`` the local part
    reaches back as far as it can, but not into the address before."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        host = EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
            free = host.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, by start, then kind."""
    out = []
    if "@" in text:
        out += [(start, 0, end) for start, end in emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if _octets(m[0])]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _only_digits(m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return sorted(out)


# ---------------------------------------------------------------- regions

_CHUNK = re.compile(r"[^\s,;=\"|]+")
_SPLIT = frozenset(",;=\"|")
_CORE = re.compile(r"[A-Za-z0-9+(\[](?:.*[A-Za-z0-9)\]])?", re.S)


class Region:
    """Chunks (start, end of their cores) and the word before the first."""

    def __init__(self, text: str, chunks: list[tuple[int, int]], before: str):
        self.text, self.chunks, self.before = text, chunks, before

    def span(self, a: int, b: int) -> tuple[int, int]:
        return self.chunks[a][0], self.chunks[b - 1][1]


_SEED = re.compile(r"[0-9@]|[(\[]\s?at\s?[)\]]")
_AT = re.compile(r"[(\[]\s?at\s?[)\]]")
_GAP = frozenset(" \t,;:.!?()[]\"'")


def regions(text: str, taken: list[tuple[int, int]] = ()) -> list[Region]:
    """Runs of chunks with a digit, an ``@`` or a bracketed at; the ``taken`` spans
    (disjoint, rising, each with a digit or an ``@``) are in no chunk and end a run. The
    neighbours of a bracketed at belong to it."""
    out: list[Region] = []
    run: list[tuple[int, int]] = []
    before, next_span, pos = "", 0, 0

    def close():
        nonlocal run
        if run:
            out.append(Region(text, run, before))
            run = []

    while seed := _SEED.search(text, pos):
        while next_span < len(taken) and taken[next_span][1] <= seed.start():
            next_span += 1
        limit = taken[next_span][0] if next_span < len(taken) else len(text)
        if limit <= seed.start():
            close()
            pos = taken[next_span][1]
            continue
        start, low = seed.start(), pos
        while start > low and not text[start - 1].isspace() and text[start - 1] not in _SPLIT:
            start -= 1
        end = max(_CHUNK.match(text, start, limit).end(), seed.end())
        if run and (start - run[-1][1] > 3 or not _GAP.issuperset(text[run[-1][1]:start])):
            close()
        if seed[0][0] in "([" and text[start:end].strip("()[] ") == "at":  # name (at) host
            left = re.search(_CHUNK.pattern + r"\s$", text[max(low, start - 80):start])
            if left and not run:
                run.append(_core(text, start - len(left[0]), start - 1))
            run.append((start, seed.end()))
            end = seed.end()
            right = re.match(rf"\s({_CHUNK.pattern})", text[end:min(limit, end + 80)])
            if right:
                run.append(_core(text, end + right.start(1), end + right.end(1)))
                end += right.end(1)
        else:
            if not run:
                words = _CHUNK.findall(text[max(0, start - 40):start])
                before = words[-1].lower().strip(":.,") if words else ""
            run.append(_core(text, start, end))
        pos = end
    close()
    return out


def _core(text: str, start: int, end: int) -> tuple[int, int]:
    m = _CORE.search(text, start, end)
    return (m.start(), m.end()) if m else (start, end)


_HINTS = {"tel", "telephone", "phone", "call", "mobile", "fax", "mail", "e-mail", "email", "contact", "card", "visa", "ip", "host", "address"}


def features(region: Region, a: int, b: int) -> list[str]:
    """Whole-span features of the candidate segment of chunks a..b."""
    start, end = region.span(a, b)
    s = region.text[start:end]
    digits = _only_digits(s)
    shape = re.sub(r"[0-9]+", lambda m: str(min(len(m[0]), 9)), re.sub(r"[A-Za-z]+", "a", re.sub(r"[^\x00-\x7f]+", "u", s)))[:24]
    letters = sum(c.isalpha() for c in s)
    at = "@" in s or bool(_AT.search(s))
    out = [f"n{b - a}", f"shape={shape}", f"digits{min(len(digits), 20)}", f"letters{min(letters, 3)}", f"at{at}",
           f"first={'d' if s[:1].isdigit() else 'a' if s[:1].isalpha() else s[:1]}", f"groups{min(len(re.findall('[0-9]+', s)), 6)}",
           f"sep={''.join(sorted(set(re.sub(r'[A-Za-z0-9]', '', s)) & set('.-() +@_[]/:')))}"]
    if 12 <= len(digits) <= 19 and not letters:
        out.append(f"luhn{luhn(digits)}")
    if s.count(".") == 3 and not letters:
        out.append("dotted" + str(re.fullmatch(r"[0-9]+(\.[0-9]+){3}(:[0-9]+)?", s) is not None and _octets(s.split(":")[0])))
    if s.count("[.]") == 3 or s.count("(.)") == 3:
        plain = s.replace("[.]", ".").replace("(.)", ".")
        out.append("bracketed" + str(re.fullmatch(r"[0-9]+(\.[0-9]+){3}", plain) is not None and _octets(plain)))
    if at:
        out.append("host" + str(re.search(r"(@|[)\]])\s?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$", s) is not None))
    if a == 0 and region.before in _HINTS:
        out.append("hint=" + region.before)
    return out


# ---------------------------------------------------------------- the field

class Field:
    """Weights by (kind, feature) and (kind, next kind)."""

    def __init__(self):
        self.w: dict[tuple, float] = defaultdict(float)

    def segments(self, region: Region) -> dict[tuple[int, int], list[str]]:
        n = len(region.chunks)
        return {(a, b): features(region, a, b) for a in range(n) for b in range(a + 1, min(n, a + MAX_CHUNKS) + 1)}

    def _scores(self, parts) -> dict[tuple, float]:
        w = self.w
        return {(a, b, k): sum(w.get((k, f), 0.0) for f in fs) for (a, b), fs in parts.items()
                for k in ((OUTSIDE, *KINDS) if b == a + 1 else KINDS)}

    def best(self, region: Region) -> list[tuple[int, int, str]]:
        """Entities of the best segmentation (ties: fewer chunks, then kind order). Scores
        are needed for the last MAX_CHUNKS columns only; of the others the way back stays,
        one byte (segment length and kind before) per column and kind."""
        if not self.w:
            return []
        n, labels = len(region.chunks), (OUTSIDE, *KINDS)
        turn = [[self.w.get((k0, k), 0.0) for k0 in labels] for k in labels]
        top: list[dict[int, float]] = [{0: 0.0}]  # column b at b % (MAX_CHUNKS + 1)
        top += [{} for _ in range(MAX_CHUNKS)]
        back = bytearray(len(labels) * (n + 1))
        for b in range(1, n + 1):
            here: dict[int, float] = {}
            for a in range(b - 1, max(-1, b - MAX_CHUNKS - 1), -1):
                scores = self._scores({(a, b): features(region, a, b)})
                for k, label in enumerate(labels):
                    s = scores.get((a, b, label))
                    if s is None:
                        continue
                    for k0, v in top[a % len(top)].items():
                        value = v + s + turn[k][k0]
                        if k not in here or value > here[k]:
                            here[k] = value
                            back[len(labels) * b + k] = len(labels) * (b - a) + k0
            top[b % len(top)] = here
        out, b = [], n
        last = top[n % len(top)]
        k = max(last, key=last.get)
        while b:
            length, k0 = divmod(back[len(labels) * b + k], len(labels))
            if k:
                out.append((b - length, b, labels[k]))
            b, k = b - length, k0
        return out[::-1]

    def gradient(self, region: Region, gold: list[tuple[int, int, str]]) -> dict[tuple, float]:
        """Gradient of the log likelihood of one region's segmentation."""
        n = len(region.chunks)
        parts = self.segments(region)
        scores = self._scores(parts)
        labels = (OUTSIDE, *KINDS)
        fwd = [dict() for _ in range(n + 1)]
        bwd = [dict() for _ in range(n + 1)]
        fwd[0][OUTSIDE] = 0.0
        for b in range(1, n + 1):
            for k in labels:
                terms = [v + scores[a, b, k] + self.w.get((k0, k), 0.0) for a in range(max(0, b - MAX_CHUNKS), b)
                         if (a, b, k) in scores for k0, v in fwd[a].items()]
                if terms:
                    fwd[b][k] = _log_sum(terms)
        bwd[n] = {k: 0.0 for k in labels}
        for a in range(n - 1, -1, -1):
            for k0 in labels:
                bwd[a][k0] = _log_sum([scores[a, b, k] + self.w.get((k0, k), 0.0) + bwd[b][k] for b in range(a + 1, min(n, a + MAX_CHUNKS) + 1)
                                       for k in labels if (a, b, k) in scores])
        total = _log_sum(list(fwd[n].values()))
        grad: dict[tuple, float] = defaultdict(float)
        for (a, b, k), s in scores.items():
            p = 0.0
            for k0, v in fwd[a].items():
                q = math.exp(v + s + self.w.get((k0, k), 0.0) + bwd[b][k] - total)
                grad[k0, k] -= q
                p += q
            for f in parts[a, b]:
                grad[k, f] -= p
        at, last = 0, OUTSIDE
        for a, b, k in [*gold, (n, n, None)]:
            for i in range(at, a):
                for f in parts[i, i + 1]:
                    grad[OUTSIDE, f] += 1
                grad[last, OUTSIDE] += 1
                last = OUTSIDE
            if k is not None:
                for f in parts[a, b]:
                    grad[k, f] += 1
                grad[last, k] += 1
                at, last = b, k
        return grad


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(t - top) for t in terms))


def variants(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The text itself and copies in which every span has another written form."""
    def phone(s, i):
        return re.sub(r"^\+[0-9]{1,3}[\s.-]?", "", s) if i % 2 else re.sub(r"[()]", "", re.sub(r"^\+", "00", s))

    def email(s, i):
        return s.replace("@", (" (at) ", " [at] ", "(at)")[i % 3])

    def card(s, i):
        d = _only_digits(s)
        return ".".join(d[j:j + 4] for j in range(0, len(d), 4))

    def ip(s, i):
        return s.replace(".", ("[.]", "(.)")[i % 2])

    forms = {0: email, 1: ip, 2: card, 3: phone}
    out = [(text, spans)]
    for i in range(2):
        pieces, found, at, size = [], [], 0, 0
        for start, k, end in spans:
            if start < at:
                continue
            new = forms[k](text[start:end], i)
            pieces += [text[at:start], new]
            size += start - at
            found.append((size, k, size + len(new)))
            size += len(new)
            at = end
        out.append(("".join([*pieces, text[at:]]), found))
    return out


def ordinary_numbers(count: int, seed: int = 11) -> list[str]:
    """Sentences with numbers that are no personal data: grouped thousands, decimals, dates,
    times, versions, book numbers, tables, sums of money, plain counts."""
    rng = random.Random(seed)
    n = rng.randint

    def digits(k):
        return "".join(str(n(0, 9)) for _ in range(k))

    def thousands(sep):
        return sep.join([str(n(1, 999)), *(f"{n(0, 999):03d}" for _ in range(n(1, 4)))])

    makers = [
        lambda: thousands(" "), lambda: thousands(","), lambda: thousands("."), lambda: f"{n(0, 9999)}.{digits(n(1, 9))}",
        lambda: f"{n(1900, 2099)}-{n(1, 12):02d}-{n(1, 28):02d}", lambda: f"{n(1, 28):02d}.{n(1, 12):02d}.{n(1900, 2099)}",
        lambda: f"{n(1, 12)}/{n(1, 28)}/{n(1900, 2099)}", lambda: f"{n(0, 23):02d}:{n(0, 59):02d}:{n(0, 59):02d}",
        lambda: f"{n(1900, 2099)}-{n(1, 12):02d}-{n(1, 28):02d}T{n(0, 23):02d}:{n(0, 59):02d}:{n(0, 59):02d}",
        lambda: f"v{n(0, 30)}.{n(0, 30)}.{n(0, 99)}", lambda: f"{n(0, 30)}.{n(0, 30)}.{n(0, 9999)}", lambda: f"{n(1, 9)}.{n(0, 9)}",
        lambda: f"978-{n(0, 9)}-{digits(n(2, 5))}-{digits(n(3, 5))}-{n(0, 9)}", lambda: "978" + digits(10),
        lambda: " ".join(str(n(0, 10 ** n(1, 3))) for _ in range(n(3, 9))), lambda: " ".join(f"{n(0, 99)}.{n(0, 99)}" for _ in range(n(2, 6))),
        lambda: " ".join(digits(n(4, 6)) for _ in range(n(2, 5))), lambda: str(n(1, 10 ** n(1, 11))), lambda: f"{n(1, 999)}%", lambda: f"${n(1, 999)},{digits(3)}.{digits(2)}",
        lambda: f"{n(1900, 2099)}-{n(1900, 2099)}", lambda: f"{n(1900, 2099)}/{n(0, 99):02d}", lambda: f"#{n(1, 10 ** 6)}", lambda: f"({n(1, 99)})",
        lambda: f"{digits(2)}-{digits(n(3, 6))}", lambda: f"{n(1, 40)}x{n(1, 40)}", lambda: f"{digits(n(1, 4))}e-{n(1, 9)}"]
    words = "the sales were about units and total table row version of page order item on at from until build chapter score".split()
    return [" ".join(part for _ in range(n(1, 3)) for part in (*rng.sample(words, n(1, 4)), rng.choice(makers)())) + rng.choice([" units", ".", "", " in all"])
            for _ in range(count)]


def training_regions(texts: list[str]) -> list[tuple[Region, list]]:
    """Regions of at most ``TRAIN_CHUNKS`` chunks with their known entities; regions with an
    entity whose ends are not chunk ends are left out."""
    out = []
    for text in texts:
        for version, spans in variants(text, base_spans(text)):
            for region in regions(version):
                starts = {c[0]: i for i, c in enumerate(region.chunks)}
                ends = {c[1]: i + 1 for i, c in enumerate(region.chunks)}
                lo, hi = region.chunks[0][0], region.chunks[-1][1]
                gold, fits, at = [], True, -1
                for start, k, end in spans:
                    if end <= lo or start >= hi:
                        continue
                    if start not in starts or end not in ends or starts[start] < at or not 0 < ends[end] - starts[start] <= MAX_CHUNKS:
                        fits = False
                        break
                    gold.append((starts[start], ends[end], KINDS[k]))
                    at = ends[end]
                if fits and len(region.chunks) <= TRAIN_CHUNKS:
                    out.append((region, gold))
    return out


def train(texts: list[str]) -> Field:
    field = Field()
    data = training_regions(texts)
    if not any(gold for _, gold in data):
        return field
    ordinary = [(r, []) for t in ordinary_numbers(ORDINARY) if not base_spans(t) for r in regions(t) if len(r.chunks) <= TRAIN_CHUNKS]
    data = [x for _, x in sorted([((i + 0.5) / len(part), x) for part in (data, ordinary) for i, x in enumerate(part)], key=lambda x: x[0])]
    seen: dict[tuple, float] = defaultdict(float)
    for _ in range(EPOCHS):
        for region, gold in data:
            for key, g in field.gradient(region, gold).items():
                if abs(g) > 1e-4:
                    seen[key] += g * g
                    field.w[key] += RATE * g / math.sqrt(seen[key] + 1e-8)
    field.w = {k: v for k, v in field.w.items() if abs(v) > 1e-3}
    return field


def find_spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each (start, kind number, end) by start, then kind."""
    base = base_spans(text)
    if not field.w:
        return base, base
    taken: list[list[int]] = []
    for start, _, end in base:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    more = []
    for region in regions(text, taken):
        for i, j, kind in field.best(region):
            start, end = region.span(i, j)
            after = bisect(taken, start, key=lambda t: t[1])
            if after == len(taken) or taken[after][0] >= end:
                more.append((start, KINDS.index(kind), end))
    return base, sorted([*base, *more])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---------------------------------------------------------------- Spark

def training_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """At most TRAIN_TEXTS short texts with candidate characters: those of the smallest id
    hashes. The hash range looked at follows the number of documents (and widens if it
    holds too few), so what the tasks send to the driver does not grow with their number."""
    rows = (docs.select(F.xxhash64(docs[id_col]).alias("h"), docs[text_col].alias("text"))
            .filter((F.length("text") <= TRAIN_CHARS) & F.col("text").rlike(r"@|\+[0-9]|[0-9]{4}|[0-9]\.[0-9]+\.[0-9]")))
    share = 64 * TRAIN_TEXTS / max(1, docs.count())
    while True:
        part = rows if share >= 1 else rows.filter(F.col("h") < F.lit(int((share - 0.5) * 2 ** 64)))
        found = part.orderBy("h", "text").limit(TRAIN_TEXTS).collect()
        if len(found) == TRAIN_TEXTS or share >= 1:
            return [r.text for r in found]
        share *= 8


def scan_pii(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (kind:start:end lists), counts of the base kinds."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(cols, texts):
        found = [find_spans(t.decode("utf-8", "replace"), shared.value) for t in texts]
        out = {f"n_{kind}": [sum(k == i for _, k, _ in b) for b, _ in found] for i, kind in enumerate(KINDS)}
        return out | {"doc_id": cols["doc_id"], "base": [written(b) for b, _ in found], "spans": [written(a) for _, a in found]}

    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    return map_arrow(source, run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string",
                     ["doc_id", "text"], "text")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping
    spans merge into the first one's mark."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The same columns with every span of ``text_col`` redacted; a null text stays null."""

    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact(t, find_spans(t, shared.value)[1]))

    return docs.withColumn(text_col, clean(F.col(text_col)))
