"""Personal data: exact base patterns, and a skip-chain conditional random field that spreads them within a document.

Tokens are white-space runs that hold a digit or an @, without surrounding punctuation. Labels: none, email, ip, card, phone. The
field has a factor for each token's shape (characters, and whether a base pattern matched but failed its test), one for each two neighbouring tokens (nothing but white space between), and a
skip factor between each token and one label of its normal form in that document, so all occurrences, however many and however far
apart, are two steps from each other. The shapes of a form's unobserved occurrences are one piece of evidence for the form's label, not one
each: their messages share a weight of 1. Tokens in a base span are observed; the others' labels come from loopy sum-product passing until no
message moves by more than STILL (or MOST_ROUNDS, for loops that do not settle), and a token whose label is not none with
probability `sure` or more adds a span.

Training is piecewise: each kind of factor is the (pointwise mutual) log-odds of its own counts over all documents,
which is its maximum-likelihood table; the counts are a few hundred numbers, whatever the input. A token without a base span that
repeats the form of one with is no example of none: it is left out of the counts. Smoothing is in shares of the counts, so
a table and the same table many times over give the same field: SMOOTH of a shape's row comes from all tokens' labels, `agreement` of the
skip table favours equal labels, and two of one form have labels of their own (independent ones) with share DIFFER.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from feedlake.llm.rows import SLICE_ROWS, map_arrow, map_texts, quoted

KINDS = ["email", "ip", "card", "phone"]
N = len(KINDS) + 1
SURE = 0.9
AGREEMENT = 0.05
SMOOTH = 0.05
DIFFER = 0.0001
STILL = 0.0001
MOST_ROUNDS = 1000

#: What the base patterns match.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*").finditer
_grouped = re.compile(r"[0-9]+(?:[ -][0-9]+)*").finditer
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer
_marked = re.compile(r"[0-9@]").search
_token = re.compile(r"[0-9@]\S*").finditer
_digits = re.compile(r"[0-9]").findall
_EDGE = ".,;:!?()[]{}<>\"'`|*#"


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, True). An @ has one leftmost match: the run of local characters before it (after the last match) and the domain behind."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _domain(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end, True
        else:
            end = max(end, at + 1)  # no match reaches back over this @
        at = text.find("@", max(end, at + 1))


def ips(text: str) -> Iterator[tuple[int, int, bool]]:
    """Runs of dotted numbers, four at a time: (start, end, whether the parts are at most 255)."""
    for m in _dotted(text):
        if m[0].count(".") < 3:
            continue
        at, parts = m.start(), m[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            yield at, at + size, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four)
            at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    """Grouped digits: (start, end, whether 13 to 19 digits pass the check sum); shorter groups are no matter."""
    for m in _grouped(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            yield *m.span(), 13 <= len(digits) <= 19 and luhn(digits)


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _phone(text):
        yield *m.span(), 9 <= len(_digits(m[0])) <= 15


def matches(text: str | None) -> tuple[list, list]:
    """Base spans (kind number, start, end), by kind, then start, and the (start, end) of matches that fail their test."""
    good, bad = [], []
    if text and _marked(text):
        for kind, find in enumerate((emails, ips, cards, phones)):
            for a, b, ok in find(text):
                if ok:
                    good.append((kind, a, b))
                else:
                    bad.append((a, b))
    return good, bad


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    return matches(text)[0]


class Tokens(NamedTuple):
    spans: list[tuple[int, int]]
    shapes: list[str]
    labels: np.ndarray  # of the base spans; 0: none
    near: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    forms: np.ndarray  # number of the form; -1: too short for one


def _over(spans: list, marks: list) -> np.ndarray:
    """The value of the first of the (start, end, value) marks over each span, by start; 0 for none."""
    out, k = np.zeros(len(spans), np.int64), 0
    for a, b, value in sorted(marks):
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        j = k
        while j < len(spans) and spans[j][0] < b:
            out[j] = out[j] or value
            j += 1
    return out


def tokens(text: str, base: list[tuple[int, int, int]], failed: list[tuple[int, int]]) -> Tokens:
    spans, near, last = [], [], 0
    for m in _token(text):
        a, b = m.span()
        while a > last and not text[a - 1].isspace():
            a -= 1
        gap, last = text[last:a], b
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        if a < b:
            if spans and gap.isspace() and len(gap) < 3:
                near.append((len(spans) - 1, len(spans)))
            spans.append((a, b))
    labels = _over(spans, [(a, b, kind + 1) for kind, a, b in base])
    fails = _over(spans, [(a, b, 1) for a, b in failed])
    shapes, skip, seen = [], [], {}
    forms, numbers = np.full(len(spans), -1), {}
    for i, (a, b) in enumerate(spans):
        t = text[a:b]
        digits = len(_digits(t))
        letters = any(map(str.isalpha, t))
        size = 0 if not digits else 1 if digits < 4 else 2 if digits < 9 else 3 if digits < 13 else 4
        shapes.append(f"{'@' in t:d}{t[0] == '+':d}{letters:d}{'-' in t:d}{min(t.count('.'), 3)}{size}{fails[i]}")
        form = "".join(filter(str.isalnum, t)).lower()
        if len(form) >= 4:
            if form in seen:
                skip.append((seen[form], i))
            seen[form] = i
            forms[i] = numbers.setdefault(form, len(numbers))
    return Tokens(spans, shapes, labels, near, skip, forms)


class Field(NamedTuple):
    """Log factors: unary by shape, N x N tables for neighbours and skips, and the label of a form."""

    unary: dict[str, np.ndarray]
    other: np.ndarray
    near: np.ndarray
    skip: np.ndarray
    form: np.ndarray


def fit(counts: dict[tuple[str, str], int], agreement: float = AGREEMENT) -> Field:
    """From counts of ("u", shape label), ("n", label label) and ("s", label label); only their proportions matter."""
    unary: dict[str, np.ndarray] = {}
    tables = {"n": np.zeros((N, N)), "s": np.zeros((N, N))}
    total = np.zeros(N)
    for (kind, key), n in counts.items():
        first, second = key.split()
        if kind == "u":
            unary.setdefault(first, np.zeros(N))[int(second)] += n
            total[int(second)] += n
        else:
            tables[kind][int(first), int(second)] += n
            tables[kind][int(second), int(first)] += n

    def smooth(c, share, by):
        """Proportions of the counts and, as `share` of them, of `by`; of `by` alone where nothing was counted."""
        return (c / c.sum() + share * by) / (1 + share) if c.sum() else by

    prior = smooth(total, SMOOTH, np.full(N, 1 / N))
    near = smooth(tables["n"], SMOOTH, np.full((N, N), 1 / N**2))
    skip = smooth(tables["s"], agreement, np.eye(N) / N)
    own = skip.sum(axis=1)
    skip = (1 - DIFFER) * skip + DIFFER * np.outer(own, own)

    def pmi(p):
        m = p.sum(axis=1)
        return np.log(p / np.outer(m, m))

    return Field({s: np.log(smooth(c, SMOOTH, prior)) for s, c in unary.items()}, np.log(prior), pmi(near), pmi(skip), np.log(own))


def marginals(field: Field, t: Tokens, rounds: int = MOST_ROUNDS) -> np.ndarray:
    """(tokens, N) label probabilities after loopy sum-product passing, base labels observed."""
    n = len(t.spans)
    score = np.array([field.unary.get(s, field.other) for s in t.shapes]).reshape(n, N)
    seen = t.labels > 0
    score[seen] = -50.0
    score[seen, t.labels[seen]] = 0.0
    # tokens of a form that occurs again, each joined to the form's own variable behind the tokens
    times = np.bincount(t.forms[t.forms >= 0], minlength=1)
    tied = np.flatnonzero((t.forms >= 0) & (times[t.forms] > 1))
    known, form = np.unique(t.forms[tied], return_inverse=True)
    score = np.concatenate([score, np.repeat(field.form[None], len(known), 0)])
    free = np.bincount(form, ~seen[tied], minlength=len(known))
    belief = score
    if t.near or len(tied):
        near = np.array(t.near, np.int64).reshape(-1, 2)
        one, two = np.concatenate([near[:, 0], tied]), np.concatenate([near[:, 1], n + form])
        table = np.concatenate([np.repeat(field.near[None], len(near), 0), np.repeat(field.skip[None], len(tied), 0)])
        weight = np.ones((2 * len(one), 1))
        weight[len(near) : len(one), 0] = np.where(seen[tied], 1, 1 / np.maximum(free[form], 1))
        src, dst = np.concatenate([one, two]), np.concatenate([two, one])
        table = np.concatenate([table, table.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(one)) + len(one), np.arange(len(one))])
        message = np.zeros((len(src), N))
        for _ in range(rounds):
            belief = score.copy()
            np.add.at(belief, dst, message)
            x = (belief[src] - message[back])[:, :, None] + table
            top = x.max(axis=1, keepdims=True)
            new = weight * (np.log(np.exp(x - top).sum(axis=1)) + top[:, 0])
            step = 0.5 * (new - new.max(axis=1, keepdims=True) - message)
            message += step
            if np.abs(step).max() < STILL:
                break
        belief = score.copy()
        np.add.at(belief, dst, message)
    belief = belief[:n]
    p = np.exp(belief - belief.max(axis=1, keepdims=True)) if n else belief
    return p / p.sum(axis=1, keepdims=True) if n else p


def all_spans(field: Field, text: str | None, sure: float = SURE) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, base) by kind, then start."""
    base, failed = matches(text)
    out = [(*s, True) for s in base]
    if text and _marked(text):
        t = tokens(text, base, failed)
        free = np.flatnonzero(t.labels == 0)
        if len(free):
            p = marginals(field, t)
            for i in free[1 - p[free, 0] >= sure]:
                out.append((int(p[i, 1:].argmax()), *t.spans[i], False))
    return sorted(out)


def train(docs: DataFrame, text: str = "text", agreement: float = AGREEMENT) -> Field:
    """The field of all documents. Tasks count, Spark sums; a bounded number of tables' cells reaches the driver."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for x in batch.column(0).slice(at, SLICE_ROWS).to_pylist():
                    if not x or not _marked(x):
                        continue
                    t = tokens(x, *matches(x))
                    known = (t.labels > 0) | (t.forms < 0) | ~np.isin(t.forms, t.forms[t.labels > 0])
                    counts.update(("u", f"{s} {y}") for s, y, k in zip(t.shapes, t.labels, known) if k)
                    counts.update(("n", f"{t.labels[i]} {t.labels[j]}") for i, j in t.near if known[i] and known[j])
                    counts.update(("s", f"{t.labels[i]} {t.labels[j]}") for i, j in t.skip if known[i] and known[j])
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in keys], pa.string()), pa.array([k for _, k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())],
            names=["factor", "cell", "n"],
        )

    counted = map_arrow(docs.select(F.col(quoted(text))), run, "factor string, cell string, n bigint")
    rows = counted.groupBy("factor", "cell").agg(F.sum("n").alias("n")).collect()  # shapes x labels at most
    return fit({(r["factor"], r["cell"]): r["n"] for r in rows}, agreement)


SPANS = ArrayType(
    StructType(
        [StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("base", BooleanType())]
    )
)


def redact(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind in brackets."""
    out, end = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{KINDS[kind].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def personal_data(docs: DataFrame, keep=("doc_id",), text: str = "text", redacted: str | None = None, sure: float = SURE) -> DataFrame:
    """`keep` columns and `spans` (kind, start, end, base; code points, end exclusive; by kind as listed, then start) of every
    row; with `redacted`, also a column of that name with the text rewritten.

    Null and empty texts have no spans, and null stays null when rewritten. Equal rows get equal spans, extra columns are not read, an empty table
    gives no rows. Two passes over the texts, no shuffle of them; the field (a few KB) travels with the function.
    """
    field = train(docs, text)

    def make():
        def run(texts):
            found = [all_spans(field, t, sure) for t in texts]
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": c} for k, a, b, c in f] for f in found]
            return (spans, [t if not f else redact(t, f) for t, f in zip(texts, found)]) if redacted else (spans,)

        return run

    fields = [StructField("spans", SPANS)]
    if redacted:
        fields.append(StructField(redacted, StringType()))
    return map_texts(docs, list(keep), text, make, fields)


def span_digest() -> list:
    """n_email, n_ip, n_card, n_phone, base_sha256 and spans (one string) as columns."""
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind))
    counts = [of(k).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return [*counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")]
