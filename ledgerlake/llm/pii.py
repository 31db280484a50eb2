"""Operator 10: personal data by weak supervision.

Candidate spans come from patterns (four base kinds and further kinds). Labelers
vote on every candidate for or against or abstain: format rules, gazetteers,
context words, token borders and placeholder digits. The vote patterns are counted
over the whole corpus by Spark; expectation-maximisation on those counts (their
number is bounded by the votes) estimates each labeler's reliability and the share
of true spans per kind. The posteriors train a final logistic span classifier on
the votes and the shape of the span; it accepts or rejects the further kinds. Base
spans always stay.

Spans are [start, end) in code points. Defined results: null or empty texts have
no spans; texts without candidates leave the model empty, which accepts nothing
but base spans. A further span that overlaps a base span or an earlier accepted one
of its kind is dropped. Rows are judged one by one (null or repeated ids need no
rule), other columns pass on.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds in listing order, patterns and word lists.
BASE = ("email", "ip", "card", "phone")
FURTHER = ("ssn", "iban", "local_phone", "spelled_email", "person")
KINDS = BASE + FURTHER
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])",
    "spelled_email": r"[A-Za-z0-9._+-]+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]+(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z]+)+",
    "person": r"(?:(?<=Mr )|(?<=Mr\. )|(?<=Mrs )|(?<=Mrs\. )|(?<=Ms )|(?<=Ms\. )|(?<=Dr )|(?<=Dr\. )|(?<=name is ))"
              r"[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?",
}
CUES = {
    "email": ("mail", "contact", "write", "@"), "ip": ("ip", "server", "host", "address", "ping"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "ssn": ("ssn", "social", "security"), "iban": ("iban", "account", "bank", "transfer"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "dial"),
    "spelled_email": ("mail", "contact", "write"), "person": ("name", "mr", "mrs", "ms", "dr", "dear"),
}
AGAINST = ("version", "isbn", "issn", "order", "invoice", "page", "figure", "section", "release", "part no", "serial")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48",
                 "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86",
                 "90", "91", "92", "351", "352", "353", "354", "358", "420", "421")
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu", "it", "nl", "ch", "at")
FIRST_NAMES = ("james", "mary", "john", "anna", "maria", "peter", "paul", "thomas", "laura", "julia", "david", "sarah",
               "michael", "emma", "lucas", "sofia", "carlos", "jean", "pierre", "hans", "klaus", "jose", "luis", "elena")
LABELERS = ("format", "gazetteer", "context", "border", "variety")
# End of the fixed values.

_RE = {k: re.compile(p) for k, p in PATTERNS.items()}
# The ip pattern from the first digit of a run on: no later digit of a run begins a match if the first does not.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_SPELLED_AT = re.compile(r"\x20?[(\[]at[)\]]\x20?")
_SPELLED_END = re.compile(r"[A-Za-z0-9-]+(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z]+)+")
_DIGIT = re.compile("[0-9]")
_WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SPELLED_LOCAL = _LOCAL - {"%"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _base_ok(kind: str, s: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        d = _digits(s)
        return 14 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 10 <= len(_digits(s)) <= 15
    return True


def _emails(text: str):
    """(start, end) of the matches of the email pattern, in time linear in the text: an @ has one longest local part
    before it, and if no domain follows the @, none of that part's characters begins a match."""
    done = 0
    at = text.find("@")
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        domain = _DOMAIN.match(text, at + 1) if lo < at else None
        if domain:
            yield lo, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _spelled(text: str):
    """(start, end) of the matches of the spelled_email pattern, alike: one longest local part before each "(at)"."""
    done = 0
    for at in _SPELLED_AT.finditer(text):
        lo = at.start()
        while lo > done and text[lo - 1] in _SPELLED_LOCAL:
            lo -= 1
        end = _SPELLED_END.match(text, at.end()) if done <= lo < at.start() else None
        if end:
            yield lo, end.end()
            done = end.end()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [(lo, hi, "email") for lo, hi in _emails(text)]
    if _DIGIT.search(text):
        for kind in ("ip", "card", "phone"):
            if kind != "phone" or "+" in text:
                found = _IP if kind == "ip" else _RE[kind]
                out += [(m.start(), m.end(), kind) for m in found.finditer(text) if _base_ok(kind, m.group())]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def further_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates of the further kinds that overlap no base span."""
    out = []
    digits = _DIGIT.search(text) is not None
    for kind in FURTHER:
        if kind in ("ssn", "iban", "local_phone") and not digits:
            continue
        if kind == "spelled_email" and "at)" not in text and "at]" not in text:
            continue
        if kind == "person" and not any(c in text for c in ("Mr", "Ms", "Dr", "name is ")):
            continue
        out += [(*s, kind) for s in (_spelled(text) if kind == "spelled_email" else (m.span() for m in _RE[kind].finditer(text)))]
    starts, furthest = [b for b, _, _ in base], list(accumulate((e for _, e, _ in base), max))
    before = lambda s: bisect_left(starts, s[1])  # noqa: E731  base spans that begin before the end of s
    return [s for s in out if not before(s) or furthest[before(s) - 1] <= s[0]]


def votes(text: str, start: int, end: int, kind: str) -> tuple[int, ...]:
    """Each labeler's vote: 1 for, -1 against, 0 abstains."""
    s, d = text[start:end], _digits(text[start:end])
    form = 0
    if kind == "ssn":
        form = -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
    elif kind == "iban":
        c = s.replace(" ", "")
        form = 1 if int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1 else -1
    elif kind in ("phone", "local_phone"):
        form = 1 if 10 <= len(d) <= 15 else -1
    elif kind == "card":
        form = 1 if luhn(d) else -1
    elif kind == "ip":
        form = 1 if all(p == "0" or not p.startswith("0") for p in s.split(".")) else -1
    elif kind in ("email", "spelled_email"):
        form = 1 if s[-1].isalpha() and ".." not in s else -1
    gaz = 0
    if kind in ("email", "spelled_email"):
        gaz = 1 if re.split(r"[^A-Za-z]+", s)[-1].lower() in TOP_DOMAINS else 0
    elif kind == "phone":
        gaz = 1 if d.startswith(COUNTRY_CODES) else -1
    elif kind == "card":
        gaz = 1 if d[0] in "3456" else -1
    elif kind == "ip":
        gaz = -1 if d.startswith("127") or s.startswith("0.") else 0
    elif kind == "person":
        gaz = 1 if s.split(" ")[0].lower() in FIRST_NAMES else 0
    near = text[max(0, start - 40): start].lower()
    cue = 1 if any(c in near for c in CUES[kind]) else -1 if any(c in near for c in AGAINST) else 0
    alone = (start == 0 or text[start - 1] not in _WORD) and (end == len(text) or text[end] not in _WORD)
    variety = 0 if len(d) < 8 else -1 if len(set(d)) <= 2 or d in "01234567890123456789" else 1
    return form, gaz, cue, 1 if alone else -1, variety


def _code(text: str, span: tuple[int, int, str]) -> int:
    """Votes, length class and first-character class packed into one number."""
    start, end, kind = span
    n = 0
    for v in votes(text, *span):
        n = n * 3 + v + 1
    size = min(3, (end - start) // 8)
    head = text[start]
    shape = 0 if head.isdigit() else 1 if head.isalpha() else 2
    return ((KINDS.index(kind) * 243 + n) * 4 + size) * 3 + shape


def _unpack(code: int) -> tuple[int, list[int], int, int]:
    code, shape = divmod(code, 3)
    code, size = divmod(code, 4)
    kind, n = divmod(code, 243)
    return kind, [n // 3 ** i % 3 - 1 for i in range(4, -1, -1)], size, shape


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                   T.StructField("kind", T.IntegerType()), T.StructField("code", T.IntegerType())]))


@F.arrow_udf(_SPANS)
def _candidates(text: pa.Array) -> pa.Array:
    ends, cols = [0], ([], [], [], [])
    for t in text:
        t = t.as_py()
        if t:
            base = base_spans(t)
            for s in base + further_spans(t, base):
                for col, v in zip(cols, (s[0], s[1], KINDS.index(s[2]), _code(t, s)), strict=True):
                    col.append(v)
        ends.append(len(cols[0]))
    spans = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in cols], names=["start", "end", "kind", "code"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with candidates: (start, end, kind, code) of every candidate span."""
    return docs.withColumn("candidates", _candidates(F.col("text")))


@dataclass
class SpanModel:
    """Labeler reliabilities, shares per kind and the accepted feature codes."""
    reliability: dict[str, tuple[float, float]] = field(default_factory=dict)
    share: dict[str, float] = field(default_factory=dict)
    accept: dict[int, float] = field(default_factory=dict)


def fit(rows: DataFrame, rounds: int = 50) -> SpanModel:
    """Fit on a table with candidates. Only counts per feature code reach the driver:
    at most kinds x 3^5 votes x 12 shapes of them."""
    got = (rows.select(F.explode("candidates.code").alias("code")).groupBy("code").count().orderBy("code").collect())
    if not got:
        return SpanModel()
    codes = [r["code"] for r in got]
    n = np.array([r["count"] for r in got], dtype=float)
    parts = [_unpack(c) for c in codes]
    kind = np.array([p[0] for p in parts])
    vote = np.array([p[1] for p in parts])
    # one reliability pair per labeler, one share per kind; priors keep empty cells proper
    hit, miss = np.full(len(LABELERS), 0.8), np.full(len(LABELERS), 0.2)
    share = np.full(len(KINDS), 0.5)
    for _ in range(rounds):
        yes = np.log(share[kind]) + np.where(vote == 1, np.log(hit), np.where(vote == -1, np.log1p(-hit), 0)).sum(1)
        no = np.log1p(-share[kind]) + np.where(vote == 1, np.log(miss), np.where(vote == -1, np.log1p(-miss), 0)).sum(1)
        post = 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))
        for k in range(len(KINDS)):
            m = kind == k
            share[k] = ((n * post)[m].sum() + 1) / (n[m].sum() + 2)
        for j in range(len(LABELERS)):
            up, cast = vote[:, j] == 1, vote[:, j] != 0
            hit[j] = ((n * post)[up].sum() + 8) / ((n * post)[cast].sum() + 10)
            miss[j] = ((n * (1 - post))[up].sum() + 2) / ((n * (1 - post))[cast].sum() + 10)
    # span classifier: logistic regression on votes, kind and shape, fitted to the posteriors
    x = np.column_stack([vote == 1, vote == -1, kind[:, None] == np.arange(len(KINDS)),
                         np.array([p[2] for p in parts])[:, None] == np.arange(4),
                         np.array([p[3] for p in parts])[:, None] == np.arange(3)]).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (post - p)) - 0.1 * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(hess, grad)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return SpanModel({a: (float(hit[j]), float(miss[j])) for j, a in enumerate(LABELERS)},
                     {k: float(share[i]) for i, k in enumerate(KINDS)},
                     {c: round(float(v), 6) for c, v in zip(codes, p, strict=True)})


def accept(rows: DataFrame, model: SpanModel, least: float = 0.5) -> DataFrame:
    """``rows`` with spans (start, end, kind name, p), sorted, instead of candidates: all
    base spans and the further ones whose p is at least ``least``."""
    out = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                    T.StructField("kind", T.StringType()), T.StructField("p", T.DoubleType())]))

    @F.arrow_udf(out)
    def chosen(spans: pa.Array) -> pa.Array:
        rows_out = []
        for row in spans.to_pylist():
            kept, last = [], {}
            for s in sorted(row or [], key=lambda s: (s["start"], s["kind"])):
                p = model.accept.get(s["code"], 0.0)
                if s["kind"] < len(BASE) or (p >= least and s["start"] >= last.get(s["kind"], 0)):
                    last[s["kind"]] = s["end"]
                    kept.append({"start": s["start"], "end": s["end"], "kind": KINDS[s["kind"]], "p": p})
            rows_out.append(kept)
        return pa.array(rows_out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                      ("kind", pa.string()), ("p", pa.float64())])))

    return rows.withColumn("spans", chosen("candidates")).drop("candidates")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with spans."""
    return accept(candidates(docs), fit(candidates(docs.select("text"))))


@F.arrow_udf(T.StringType())
def _masked(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, row in zip(text, spans, strict=True):
        row = row.as_py()
        if not row:
            out.append(t.as_py())
            continue
        t, done, parts = t.as_py(), 0, []
        for s in row:
            if s["start"] >= done:
                parts += [t[done:s["start"]], f"<{s['kind'].upper()}>"]
            done = max(done, s["end"])
        out.append("".join([*parts, t[done:]]))
    return pa.array(out, pa.string())


def mask(rows: DataFrame) -> DataFrame:
    """``rows`` with every span of text replaced by its kind, as in <EMAIL>; overlapping
    spans are replaced once, by the first; spans is dropped."""
    return rows.withColumn("text", _masked("text", "spans")).drop("spans")
