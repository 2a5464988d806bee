"""Secret scan: known shapes, and a randomness test battery for the rest.

Base shapes (assignments, access keys, hexadecimal runs) are patterns. The
battery looks at the code characters around those, in runs of 20 or more. A
run is read in every way its separators (``+/_-``) allow: each may part
tokens, belong to the encoding, or only group its characters. Every part of
20 or more characters is a candidate; the encoding is inferred from the
characters used, and the question is whether the candidate could have been
drawn at random from that alphabet:

* chi-squared uniformity of the symbols, in bins of equal expected count
  (at least five) so that short runs are tested too;
* Wald-Wolfowitz runs above and below the middle of the alphabet;
* lag-1 serial correlation of the symbol values.

A candidate that fails a test (Bonferroni over the three) is structured, not
random. For one that passes, the evidence against "this is text" is the
likelihood of the run under the uniform alphabet against a first-order
character model of the document's own text. Its reciprocal bounds the
p-value of the text hypothesis (Markov's inequality) and falls with every
character, so the control is length-aware by itself. Benjamini-Hochberg
over a document's candidates keeps the share of false discoveries below
``fdr``. Of discoveries that overlap, the one with the most evidence stays;
for this choice a separator counts against the candidate it is in.

Positions are code points, ends exclusive. Null text counts as empty and has
no spans. A null or repeated id, or a repeated row, is a row like any other.
An empty table gives no rows. Other columns are not read, except by
``redact``, which returns them as they are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import id_and_text, slices

KINDS = ("assign", "access", "hex", "random")  # output order at one start
FALSE_DISCOVERIES = 1e-3
STRUCTURED = 1e-3  # battery level below which a run is not random
SHORTEST = 20  # characters of a run the battery looks at

# Patterns run on one byte per code point ("?" for any other than ASCII), so
# offsets are code points and case folds for ASCII letters alone.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
CODE = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN = re.compile(rb"x{%d,}" % SHORTEST)
SEPARATORS = b"+/_-"
SEPARATOR_PRICE = 3.0  # evidence in nats that a separator costs where candidates overlap


def _mask(members: bytes) -> bytes:
    return bytes(ord("x") if b in members else ord(" ") for b in range(256))


CODE_MASK, HEX_MASK = _mask(CODE), _mask(b"0123456789abcdef")
ALPHABETS = (
    ("hex", b"0123456789abcdef"),
    ("hex", b"0123456789ABCDEF"),
    ("base32", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", b"abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base36", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("base64", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


def infer_alphabet(run: bytes) -> bytes | None:
    """The smallest alphabet that has the run's characters; none for plain
    numbers and for words (one case, or a capital first)."""
    if run.isdigit():
        return None
    letters = run.replace(b"-", b"").replace(b"_", b"").replace(b"/", b"").replace(b"+", b"")
    if letters.isalpha() and (letters.islower() or letters.isupper() or letters[1:].islower()):
        return None
    used = set(run)
    return next((signs for _, signs in ALPHABETS if used <= set(signs)), None)


def chi2_tail(x: float, freedom: int) -> float:
    """P(chi-squared >= x): the upper regularized gamma function."""
    a, x = freedom / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:  # series of the lower function
        term = total = 1 / a
        n = a
        while term > 1e-12 * total:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - front * total)
    b, c = x + 1 - a, 1e300  # continued fraction
    d = h = 1 / b
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-12:
            break
    return min(1.0, front * h)


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(values: list[int], size: int) -> tuple[float, float, float]:
    """p-values of uniformity, runs and serial correlation."""
    n = len(values)
    bins = max(2, min(size, n // 5))
    counts, room = [0] * bins, [0] * bins
    for v in range(size):
        room[v * bins // size] += 1
    for v in values:
        counts[v * bins // size] += 1
    uniform = chi2_tail(sum((c - n * r / size) ** 2 / (n * r / size) for c, r in zip(counts, room)), bins - 1)
    high = [2 * v >= size for v in values]
    n1 = sum(high)
    n0 = n - n1
    if n1 and n0:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
        mean = 2 * n1 * n0 / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = two_sided((runs - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        runs_p = 2.0 ** (1 - n)
    mean = sum(values) / n
    off = [v - mean for v in values]
    power = sum(x * x for x in off)
    serial = two_sided((sum(a * b for a, b in zip(off, off[1:])) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    return uniform, runs_p, serial


# Rounded shares of the letters a-z in European prose, per mille.
LETTER_SHARES = (80, 12, 32, 42, 140, 13, 16, 35, 75, 4, 6, 45, 27, 78, 66, 24, 6, 66, 68, 76, 35, 13, 12, 3, 12, 4)


class TextModel:
    """First-order character model of a document, letters of one case, backed
    by single-character shares and those by the shares of letters in prose."""

    def __init__(self, text: bytes, without: list[tuple[int, int]]):
        kept, at = [], 0
        for start, end in without:
            kept.append(text[at:start])
            at = end
        folded = b" ".join([*kept, text[at:]]).lower()
        self.single: dict[int, float] = {97 + i: 0.5 * s for i, s in enumerate(LETTER_SHARES)}
        for b in set(folded):
            self.single[b] = self.single.get(b, 0) + folded.count(bytes([b]))
        self.total = sum(self.single.values()) + 64
        self.folded = folded
        self.pairs: dict[bytes, int] = {}

    def _count(self, pair: bytes) -> int:
        if pair not in self.pairs:
            self.pairs[pair] = self.folded.count(pair)
        return self.pairs[pair]

    def log_likelihoods(self, run: bytes) -> list[float]:
        """Of each character, behind the one before."""
        run, logs = run.lower(), []
        for i, b in enumerate(run):
            share = (self.single.get(b, 0) + 1) / self.total
            if i:
                before = self.single.get(run[i - 1], 0)
                share = (self._count(run[i - 1:i + 1]) + 16 * share) / (before + 16)
            logs.append(math.log(min(1.0, share)))
        return logs


def candidates(run: bytes) -> list[tuple[int, int, bytes]]:
    """``(start, end, body)``: the parts of a run for every choice of the
    separators that part it, as they are and without their separators."""
    present = [bytes([c]) for c in SEPARATORS if c in run]
    found = set()
    for n in range(len(present) + 1):
        for parting in combinations(present, n):
            pattern = b"[^" + re.escape(b"".join(parting)) + b"]+" if parting else b"(?s:.+)"
            for m in re.finditer(pattern, run):
                for body in (m[0], m[0].translate(None, SEPARATORS)):
                    if len(body) >= SHORTEST:
                        found.add((*m.span(), body))
    return sorted(found)


def random_runs(text: bytes, taken: list[tuple[int, int]], fdr: float) -> list[tuple[int, int]]:
    """Spans that pass the battery and the document's control, none of which
    overlaps another one or a span in ``taken``."""
    mask = bytearray(text.translate(CODE_MASK))
    for a, b in taken:
        mask[a:b] = b" " * (b - a)
    tested = []
    for m in RUN.finditer(mask):
        for a, b, body in candidates(text[m.start():m.end()]):
            signs = infer_alphabet(body)
            if signs:
                tested.append((m.start() + a, m.start() + b, body, signs))
    if not tested:
        return []
    without: list[tuple[int, int]] = []
    for a, b in sorted([*taken, *((a, b) for a, b, _, _ in tested)]):
        if not without or b > without[-1][1]:
            without.append((max(a, without[-1][1]) if without else a, b))
    model = TextModel(text, without)
    judged = []
    for a, b, body, signs in tested:
        place = {c: i for i, c in enumerate(signs)}
        if min(1.0, 3 * min(battery([place[c] for c in body], len(signs)))) < STRUCTURED:
            continue
        folded = math.log(len(set(signs.lower())))
        evidence = [x + folded for x in model.log_likelihoods(body)]
        own = sum(x for x, c in zip(evidence, body) if c not in SEPARATORS)
        own += SEPARATOR_PRICE * sum(c in SEPARATORS for c in text[a:b])
        judged.append((min(0.0, sum(evidence)), own, a, b))
    judged.sort()
    last = 0
    for rank, (log_p, *_) in enumerate(judged, 1):
        if log_p <= math.log(fdr * rank / len(tested)):
            last = rank
    kept: list[tuple[int, int]] = []
    for _, a, b in sorted((own, a, b) for _, own, a, b in judged[:last]):
        if not any(a < y and x < b for x, y in kept):
            kept.append((a, b))
    return kept


def scan(text: str, fdr: float = FALSE_DISCOVERIES) -> list[tuple[int, int, int, int]]:
    """``(start, end, kind number, start of the secret itself)``, in order."""
    signs = text.encode("ascii", "replace")
    spans = []
    folded = signs.lower()
    if any(w in folded for w in WORDS):
        spans += [(*m.span(), 0, m.start(2)) for m in ASSIGN.finditer(signs) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in signs:
        spans += [(*m.span(), 1, m.start()) for m in ACCESS.finditer(signs) if m.end() - m.start() >= 20]
    if b"x" * 24 in signs.translate(HEX_MASK):
        spans += [(*m.span(), 2, m.start()) for m in HEX.finditer(signs) if m.end() - m.start() >= 24]
    if b"x" * SHORTEST in signs.translate(CODE_MASK):
        taken = [(a, b) for a, b, _, _ in spans]
        spans += [(a, b, 3, a) for a, b in random_runs(signs, taken, fdr)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scan_batches(fdr: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2048):
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k, _ in scan(t, fdr)]
                         for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(spans, pa.list_(SPAN))],
                                                 ["doc_id", "spans"])

    return run


def secret_spans(docs: DataFrame, fdr: float = FALSE_DISCOVERIES) -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end) of every row."""
    return id_and_text(docs).mapInArrow(
        _scan_batches(fdr), "doc_id long, spans array<struct<kind:string, start:long, end:long>>")


def digest(spans: DataFrame) -> DataFrame:
    """Counts and checksums of ``secret_spans``."""
    def joined(column):
        return F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return spans.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _redact_batches(mark: str, fdr: float):
    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for _, end, _, start in scan(text, fdr):
            if end > at:
                out += [text[at:max(at, start)], mark]
                at = end
        return "".join([*out, text[at:]]) if out else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, 2048):
                at = rows.schema.get_field_index("text")
                texts = pa.array([clean(t) for t in rows.column(at).to_pylist()], rows.column(at).type)
                yield rows.set_column(at, rows.schema.field(at), texts)

    return run


def redact(docs: DataFrame, mark: str = "[secret]", fdr: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by ``mark``; of an
    assignment only the value. Every row and column stays; null stays null."""
    return docs.mapInArrow(_redact_batches(mark, fdr), docs.schema)
