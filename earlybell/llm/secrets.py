"""Secret scan with multipart credential linking.

Base candidates stand on their own: an assignment to a password-like name, an access
identifier, a long hexadecimal string. Weak candidates do not: endpoints, account
names and loose random-looking strings are everywhere. They are reported only where
complementary parts of one credential co-occur in one scope, which an interval join
finds: each weak part's interval, widened by the reach, is joined with the strong
parts' intervals of the same paragraph. A loose string needs an access identifier,
an account name or an endpoint beside it; an account or an endpoint needs a secret.
One span plays one part: a loose string inside an endpoint counts as none beside
endpoints, and one inside an account as none beside accounts and endpoints.

* null or empty text: no spans
* repeated documents are judged row by row; ties at one start go by kind as listed
* an input column named like a result column gives way to it
* the work per text is linear but for the joins, which are linear in parts and hits
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from earlybell.llm.common import annotate, blobs

#: Kinds in listed order: base ones, then those that only a link makes worth reporting.
BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("loose", "account", "endpoint")
KINDS = (*BASE_KINDS, *WEAK_KINDS)
#: Code points between parts that still belong together.
REACH = 200

ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
LOOSE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
ACCOUNT = re.compile(rb"""\b(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""")
ACCOUNT_NAMES = (b"user", b"login", b"account", b"client")
ENDPOINT = re.compile(rb"\b[a-z][a-z0-9+.-]{1,15}://[^\x09-\x0D\x20\"'<>]+")
PARAGRAPH = re.compile(rb"\n[ \t\r]*\n")

#: What a weak part needs beside it.
COMPLEMENTS = {
    "loose": ("access", "account", "endpoint"),
    "account": ("assign", "hex", "loose"),
    "endpoint": ("assign", "hex", "access"),
}

SPAN = StructType(
    [StructField("kind", StringType(), False), StructField("start", LongType(), False), StructField("end", LongType(), False)]
)
FIELDS = [StructField("secret_spans", ArrayType(SPAN, False))]


def _assigns(text: bytes, lower: bytes) -> Iterator[tuple[int, int]]:
    if any(name in lower for name in ASSIGN_NAMES):
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= 6:
                yield m.span()


def _accesses(text: bytes) -> Iterator[tuple[int, int]]:
    if b"AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield m.span()


def _random_looking(s: bytes) -> bool:
    """Digits and letters in both or mixed runs, as keys have and words have not."""
    digits = sum(48 <= c <= 57 for c in s)
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in s)
    return digits >= 3 and letters >= 3 and len(set(s)) >= 8


def parts(text: bytes) -> dict[str, list[tuple[int, int]]]:
    """Spans of every kind in bytes; weak ones are looked for only where any strong part
    or two kinds of weak parts can complement each other."""
    lower = text.lower()
    found = {
        "assign": list(_assigns(text, lower)),
        "access": list(_accesses(text)),
        "hex": [m.span() for m in HEX.finditer(text)],
    }
    found["endpoint"] = [m.span() for m in ENDPOINT.finditer(text)] if b"://" in text else []
    found["account"] = (
        [m.span() for m in ACCOUNT.finditer(text)] if any(name in lower for name in ACCOUNT_NAMES) else []
    )
    found["loose"] = (
        [m.span() for m in LOOSE.finditer(text) if _random_looking(m.group())]
        if found["access"] or found["account"] or found["endpoint"]
        else []
    )
    return found


def _near(weak: np.ndarray, strong: np.ndarray, scopes: np.ndarray) -> np.ndarray:
    """Interval join: which weak spans have a strong one of their scope within reach.

    ``strong`` is sorted by start, its spans do not overlap, so ends ascend too: the
    first that ends inside the widened interval decides.
    """
    if not len(weak) or not len(strong):
        return np.zeros(len(weak), bool)
    scope = np.searchsorted(scopes, weak[:, 0], side="right")
    low = np.concatenate([[0], scopes])[scope]
    high = np.concatenate([scopes, [np.iinfo(np.int64).max]])[scope]
    first = np.searchsorted(strong[:, 1], np.maximum(weak[:, 0] - REACH, low + 1))
    start = np.where(first < len(strong), strong[np.minimum(first, len(strong) - 1), 0], np.iinfo(np.int64).max)
    return start <= np.minimum(weak[:, 1] + REACH, high - 1)


def linked(text: bytes) -> list[tuple[str, int, int]]:
    """Base spans, and the weak ones that complementary parts support, in code points; by
    start, then kind as listed. No span supports one that it overlaps."""
    found = {k: np.asarray(v, np.int64).reshape(-1, 2) for k, v in parts(text).items()}
    if not any(map(len, found.values())):
        return []
    points = None if text.isascii() else np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    if points is not None:
        found = {k: points[v] for k, v in found.items()}
    out = [(k, a, b) for k in BASE_KINDS for a, b in found[k].tolist()]
    if any(len(found[k]) for k in WEAK_KINDS):
        scopes = np.asarray([m.end() for m in PARAGRAPH.finditer(text)], np.int64)
        out += _supported(found, scopes if points is None else points[scopes])
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _supported(found: dict[str, np.ndarray], scopes: np.ndarray) -> list[tuple[str, int, int]]:
    base = np.concatenate([found[k] for k in BASE_KINDS])
    base = base[np.lexsort((base[:, 1], base[:, 0]))]
    # what a base span already reports is no loose string
    loose = found["loose"][~_overlaps(found["loose"], base)]
    found = found | {"loose": loose}
    named, inside = (_overlaps(loose, found[k]) for k in ("account", "endpoint"))
    barred = {"account": named, "endpoint": named | inside}
    out = []
    for kind in WEAK_KINDS:
        close = np.zeros(len(found[kind]), bool)
        for other in COMPLEMENTS[kind]:
            if other == "loose":
                close |= _near(found[kind], loose[~named], scopes)
            elif kind == "loose" and other in barred:
                close |= _near(loose, found[other], scopes) & ~barred[other]
            else:
                close |= _near(found[kind], found[other], scopes)
        out += [(kind, a, b) for a, b in found[kind][close].tolist()]
    return out


def _overlaps(spans: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which spans overlap one of ``others`` (sorted by start)."""
    if not len(spans) or not len(others):
        return np.zeros(len(spans), bool)
    reach = np.maximum.accumulate(others[:, 1])
    before = np.searchsorted(others[:, 0], spans[:, 1])  # those that start before the span ends
    return (before > 0) & (reach[np.maximum(before - 1, 0)] > spans[:, 0])


def _compute(column: pa.Array) -> list[list]:
    return [[[{"kind": k, "start": a, "end": b} for k, a, b in linked(text)] for text in blobs(column)]]


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``secret_spans``: kind, start and end (code points, end exclusive).

    A scope lies inside one text, so the join runs where the text is: no shuffle.
    """
    return annotate(docs, text, FIELDS, _compute, keep)


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Documents whose reported spans are replaced by a mark; other columns stay.

    Overlapping spans become one mark. Null text stays null.
    """
    columns = docs.columns

    def compute(column: pa.Array) -> list[list]:
        out: list[str | None] = []
        for valid, body in zip(column.is_valid().to_pylist(), blobs(column), strict=True):
            out.append(_redacted(body, mark) if valid else None)
        return [out]

    made = annotate(docs, text, [StructField(text, StringType())], compute)
    return made.select(*[F.col(f"`{c}`") for c in columns])


def _redacted(text: bytes, mark: str) -> str:
    whole, out, at = text.decode("utf-8", "replace"), [], 0
    for _, a, b in linked(text):
        if a >= at:
            out += [whole[at:a], mark]
        at = max(at, b)
    return "".join([*out, whole[at:]])
