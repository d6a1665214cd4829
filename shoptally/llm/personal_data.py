"""Personal data by weak supervision.

Four exact kinds are found by rule and always reported. Looser candidates (local phone numbers, spelled-out e-mail
addresses, secrets in assignments, identity numbers, names) are judged: labelers of form, gazetteer, context and shape vote
+1, -1 or 0 on every span, expectation-maximisation estimates how reliable each labeler is without labelled data, and a
logistic classifier of span features is trained on the resulting posteriors. It decides on the candidates.

Votes and features take few values, so both fits run on counts of their combinations: the whole corpus is used and at most
a few thousand rows reach the driver.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.llm.common import table
from shoptally.session import checkpointed

# Kinds in reporting order; the first four are the exact ones.
KINDS = ("email", "ip", "card", "phone", "secret", "national_id", "name")
EXACT = 4

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Fixed values of the gazetteer and context labelers.
TOP_DOMAINS = frozenset("com org net edu gov io info de fr es uk eu example test".split())
FIRST_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Charles Karen Anna Peter Hans Pierre Marie Carlos Maria Juan Carmen"
).split()
SECRET_NAMES = frozenset("token secret password passwd api_key api-key apikey".split())
HINTS = {
    "email": ("mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "pay", "karte", "tarjeta", "carte"),
    "phone": ("call", "phone", "tel", "mobile", "fax", "contact", "+"),
    "secret": ("token", "secret", "password", "passwd", "key"),
    "national_id": ("ssn", "social", "passport", "id"),
    "name": ("mr", "mrs", "ms", "dr", "herr", "frau", "senor", "my name", "by"),
}
AGAINST = ("version", "isbn", "page", "figure", "order", "chapter", "vol.", "no.")

_CANDIDATES = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[A-Za-z0-9-]++)+"),
    "phone": re.compile(r"(?<![0-9.+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])?[0-9]{3}[-.][0-9]{4}(?![0-9.-])"),
    "secret": re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key)\b\x20?[=:]\x20?[\"']?([A-Za-z0-9_/+-]{12,})"),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "name": re.compile(r"\b(?:" + "|".join(FIRST_NAMES) + r")\x20[A-Z][a-z]{2,}\b"),
}
_CONTEXT = 30
PRIOR = 0.05  # weight of the labelers' prior, as a share of all spans


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def exact_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` of the exact kinds, in reporting order; offsets count code points."""
    if not text:
        return []
    found = [(0, *span) for span in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((3, *m.span()))
    return found


def _votes(text: str, kind: str, start: int, end: int, exact: bool) -> tuple[int, ...]:
    """Votes of form, gazetteer, context and shape, then the span's features (length class, digit share class)."""
    span = text[start:end]
    before = text[max(0, start - _CONTEXT) : start].lower()
    form = 1 if exact else (0 if kind in ("phone", "name") else 1)
    gazetteer = 0
    if kind == "email":
        gazetteer = 1 if span.rsplit(".", 1)[-1].lower() in TOP_DOMAINS else -1
    elif kind == "name":
        gazetteer = 1
    elif kind == "secret":
        gazetteer = 1 if any(n in before for n in SECRET_NAMES) else -1
    context = 1 if any(h in before for h in HINTS[kind]) else (-1 if any(a in before for a in AGAINST) else 0)
    digits = sum(c.isdigit() for c in span)
    if kind in ("card", "phone", "national_id", "ip"):
        shape = 1 if len(set(c for c in span if c.isdigit())) > 2 else -1
    elif kind == "secret":
        shape = 1 if 0 < digits < len(span) else -1
    else:
        shape = 1 if digits < len(span) / 2 else -1
    return form, gazetteer, context, shape, min(7, len(span) // 6), digits * 4 // max(1, len(span))


def all_spans(text: str | None) -> list[tuple[int, ...]]:
    """Exact spans and candidates ``(kind, start, end, exact, votes..., features...)``; candidates do not overlap exact spans."""
    if not text:
        return []
    sure = exact_spans(text)
    out = [(k, s, e, 1, *_votes(text, KINDS[k], s, e, True)) for k, s, e in sure]
    taken = bytearray(len(text))
    for _, s, e in sure:
        taken[s:e] = b"\1" * (e - s)
    for kind, pattern in _CANDIDATES.items():
        if kind == "email" and "at" not in text:
            continue
        for m in pattern.finditer(text):
            s, e = m.span(1) if m.re.groups else m.span()
            if 1 not in taken[s:e]:
                taken[s:e] = b"\1" * (e - s)
                out.append((KINDS.index(kind), s, e, 0, *_votes(text, kind, s, e, False)))
    return out


FIELDS = ("kind", "start", "end", "exact", "form", "gazetteer", "context", "shape", "size", "digits")
VOTES = FIELDS[4:8]
FEATURES = ("kind", *FIELDS[6:])
_SPANS = "array<struct<" + ",".join(f"{f}:int" for f in FIELDS) + ">>"


def spans_of(text: str):
    """Column of all spans of the text column."""

    @F.pandas_udf(_SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(FIELDS, s, strict=True)) for s in all_spans(t)] for t in texts], dtype=object)

    return spans(text)


def reliabilities(votes: np.ndarray, counts: np.ndarray, sure: np.ndarray | None = None, rounds=100) -> tuple[np.ndarray, np.ndarray]:
    """Dawid-Skene by expectation-maximisation on distinct vote rows: P(vote | truth) for each labeler, posterior of each row.

    Rows that are ``sure`` are true. Three things tie the classes down, whatever the size of the corpus: labelers start from a
    prior of being better than chance, worth ``PRIOR`` of the rows; a labeler that the data makes worse than chance counts as
    one that knows nothing; and no row may be less probable than one that every labeler votes against or not for as much, so a
    row with all votes in favour is at least as probable as the share of true rows.
    """
    sure = np.zeros(len(votes), dtype=bool) if sure is None else sure
    cast = np.maximum(1, (votes != 0).sum(axis=1))
    truth = np.where(sure, 1.0, np.clip(0.5 + votes.sum(axis=1) / (2 * cast), 0.05, 0.95))
    pseudo = 1.0 + PRIOR * counts.sum() * np.array([[0.6, 0.2, 0.2], [0.2, 0.2, 0.6]])[:, None, :]
    table_ = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        weights = np.stack([counts * (1 - truth), counts * truth])
        for v in (-1, 0, 1):
            table_[:, :, v + 1] = weights @ (votes == v)
        table_ += pseudo
        table_ /= table_.sum(axis=2, keepdims=True)
        ratio = np.log(table_[1]) - np.log(table_[0])
        ratio[:, 0], ratio[:, 2] = np.minimum(ratio[:, 0], 0.0), np.maximum(ratio[:, 2], 0.0)
        ratio[:, 1] = np.clip(ratio[:, 1], ratio[:, 0], ratio[:, 2])
        loose = counts * ~sure
        prior = ((loose * truth).sum() + 1 + PRIOR * counts.sum()) / (loose.sum() + 2 + 2 * PRIOR * counts.sum())
        score = np.log(prior / (1 - prior)) + sum(ratio[j, votes[:, j] + 1] for j in range(votes.shape[1]))
        new = np.where(sure, 1.0, 1 / (1 + np.exp(np.clip(-score, -50, 50))))
        if np.abs(new - truth).max() < 1e-9:
            break
        truth = new
    return table_, truth


def design(rows: np.ndarray) -> np.ndarray:
    """One-hot features of rows (kind, context, shape, size, digits) with an intercept."""
    widths = (len(KINDS), 3, 3, 8, 5)
    shifted = rows + np.array([0, 1, 1, 0, 0])
    parts = [np.eye(w)[shifted[:, j]] for j, w in enumerate(widths)]
    return np.hstack([np.ones((len(rows), 1)), *parts])


def train_classifier(rows: np.ndarray, truth: np.ndarray, counts: np.ndarray, ridge=1.0, rounds=50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps, on distinct feature rows with soft labels."""
    x, w = design(rows), np.zeros(design(rows[:1]).shape[1] if len(rows) else 27)
    for _ in range(rounds if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (truth - p)) - ridge * w
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(spanned: DataFrame) -> np.ndarray:
    """Classifier weights from a table with a column ``spans``; only counts of vote and feature combinations are collected."""
    each = spanned.select(F.explode("spans").alias("s")).select("s.*")
    keys = [f for f in FIELDS if f not in ("start", "end")]
    found = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(keys)
    if not len(found):
        return train_classifier(np.zeros((0, 5), dtype=int), np.zeros(0), np.zeros(0))
    counts = found.n.to_numpy(dtype=float)
    _, truth = reliabilities(found[list(VOTES)].to_numpy(), counts, found["exact"].to_numpy() == 1)
    return train_classifier(found[list(FEATURES)].to_numpy(), truth, counts)


def accepted(spans, weights: np.ndarray, least=0.5) -> list[tuple[int, int, int]]:
    """Exact spans and the candidates whose probability reaches ``least``, as (kind, start, end) in reporting order."""
    out = [tuple(s[f] for f in ("kind", "start", "end")) for s in spans if s["exact"]]
    loose = [s for s in spans if not s["exact"]]
    if loose:
        p = 1 / (1 + np.exp(-design(np.array([[s[f] for f in FEATURES] for s in loose])) @ weights))
        out += [tuple(s[f] for f in ("kind", "start", "end")) for s, q in zip(loose, p, strict=True) if q >= least]
    return sorted(out)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every row of ``docs (doc_id, text)``.

    Null and empty texts have no spans; repeated rows are reported each; an empty table gives an empty result.
    """
    spanned = checkpointed(docs.select("doc_id", spans_of("text").alias("spans")))
    weights = fit(spanned)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def report(spans: pd.Series) -> pd.DataFrame:
        rows = []
        for found in spans:
            base = sorted((s["kind"], s["start"], s["end"]) for s in found if s["exact"])
            counts = [sum(k == i for k, _, _ in base) for i in range(EXACT)]
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(accepted(found, weights))))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return spanned.select("doc_id", report("spans").alias("r")).select("doc_id", "r.*")


def redact(text: str | None, spans) -> str | None:
    """``text`` with each span replaced by its kind in angle brackets; spans that touch an earlier one are merged into it."""
    if not spans:
        return text
    out, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, -end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by placeholders, all columns as in ``docs``.

    Clean, empty and null texts stay as they are, rows that repeat are treated alike, an empty table gives an empty result.
    The texts are searched once: rows and spans are written together.
    """
    found = checkpointed(docs.select(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"), spans_of("text").alias("spans")))
    weights = fit(found)

    @F.pandas_udf("string")
    def clean(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([redact(t, accepted(s, weights)) for t, s in zip(text, spans, strict=True)], dtype=object)

    places = {c: f"row.c{i}" for i, c in enumerate(docs.columns)}
    cleaned = F.when(F.size("spans") > 0, clean(F.when(F.size("spans") > 0, F.col(places["text"])), "spans")).otherwise(F.col(places["text"]))
    return found.select(*[(cleaned if c == "text" else F.col(places[c])).alias(c) for c in docs.columns])


def op8_personal_data(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op8_personal_data": op8_personal_data}
