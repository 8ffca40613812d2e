"""Secret scans by assignment-aware lexing.

Two layers over every whole text:

* Base: three fixed patterns (``assign``, ``access``, ``hex``), leftmost and non-overlapping per kind.
* Method: a lexer reads ``name = literal``, ``name: literal`` and ``name => literal`` pairs of source and
  configuration syntax. Constants propagate: a name that is later assigned to, or concatenated into, another
  name carries its literal along, so ``part = "..."; api_key = part`` flags the literal of ``part``. A literal
  is scored by how sensitive the names that it reaches are and by how random it looks. Literals over the
  threshold become spans of kind ``lit`` unless a base span already covers them.

Spans are code points, end exclusive. Null text counts as empty: no span. Rows are treated one by one, so
repeated rows, empty tables and further columns of any name do not matter. Memory is bounded by the longest
text. There is no shuffle; a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed patterns of the contract. Fixed values.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # as long a run as [0-9a-f]+ takes, with short runs dropped
KINDS = ("assign", "access", "hex", "lit")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

#: How sensitive a segment of a target name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 1.0, "auth": 0.6, "bearer": 0.8, "key": 0.5,
    "signature": 0.5, "cookie": 0.5,
}
STEMS = ("pass", "pwd", "secret", "token", "key", "cred", "auth", "bearer", "signature", "cookie")
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|changeme|example|placeholder|none|null|true|false|todo|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\})$")
#: name, operator, right side: quoted literals, bare words and names joined by +. A name without them is taken whole too (no
#: later part of it can begin a pair), so that names and literals of any length are read in linear time.
TERM = r"""(?:"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|[A-Za-z0-9_][A-Za-z0-9+/_.=-]*+)"""
PAIR = re.compile(
    r"""(?a)(?<![A-Za-z0-9_])(?:["']?(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)["']?[\x20\t]*(?P<op>:=|=>|=(?!=)|:(?!:))[\x20\t]*"""
    rf"""(?P<value>{TERM}(?:[\x20\t]*\+[\x20\t]*{TERM})*+)|[A-Za-z_][A-Za-z0-9_.-]*+)"""
)
TERM_RE = re.compile(TERM)
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def sensitivity(name: str) -> float:
    parts = [p.lower() for p in re.split(r"[_.\-]+", CAMEL.sub("_", name)) if p]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in parts + joined), default=0.0)


def randomness(literal: str) -> float:
    """0 to 1: entropy a character, with a bonus for mixed character classes and length."""
    n = len(literal)
    if n < 8 or PLACEHOLDER.match(literal):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    classes = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if not re.search("[0-9]", literal) and classes < 3:
        return 0.0
    return min(1.0, entropy / 4.5) * min(1.0, n / 12) * (0.7 + 0.1 * classes)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = []
    low = text.lower()
    if any(s in low for s in ("passw", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def literal_spans(text: str, threshold: float = 0.45) -> list[tuple[int, int, float]]:
    """Literals that reach a sensitive name, directly or through constants: start, end, score."""
    low = text.lower()
    if not any(s in low for s in STEMS):
        return []
    known: dict[str, int] = {}  # the last pair of each name
    pairs: list[tuple[list[tuple[int, int]], list[int]]] = []  # literals of a pair, and earlier pairs that it takes up
    weight: list[float] = []
    for m in PAIR.finditer(text):
        if not m["name"]:
            continue
        held, taken = [], []
        for t in TERM_RE.finditer(text, m.start("value"), m.end("value")):
            raw = t[0]
            if raw[0] in "\"'":
                held.append((t.start() + 1, t.end() - 1))
            elif raw in known:
                taken.append(known[raw])
            else:
                held.append((t.start(), t.end()))
        known[m["name"]] = len(pairs)
        pairs.append((held, taken))
        weight.append(sensitivity(m["name"]))
    best: dict[tuple[int, int], float] = {}
    for k in range(len(pairs) - 1, -1, -1):  # a pair takes up earlier ones only, so each is settled when its turn comes
        held, taken = pairs[k]
        if weight[k]:
            for j in taken:
                weight[j] = max(weight[j], weight[k])
            for span in held:
                score = weight[k] * randomness(text[span[0] : span[1]])
                if score > 0:
                    best[span] = score
    return sorted((a, b, s) for (a, b), s in best.items() if s >= threshold)


def scan_text(text: str | None, threshold: float = 0.45) -> tuple[list, list]:
    """Base spans, and all spans (base ones and literals outside them), by start then kind."""
    text = text or ""
    base = base_spans(text)
    extra = [(a, b, "lit") for a, b, _ in literal_spans(text, threshold) if not any(s <= a and b <= e for s, e, _ in base)]
    return base, sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2])))


def digest(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.45) -> DataFrame:
    """id_col, spans: array of (kind, start, end, base), one row per input row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for b in batches:
            rows = []
            for text in b.column(1):
                base, spans = scan_text(text.as_py(), threshold)
                known = set(base)
                rows.append([{"kind": k, "start": s, "end": e, "base": (s, e, k) in known} for s, e, k in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(item))], names=["id", "spans"])

    schema = f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redact_text(text: str | None, spans) -> str | None:
    """The text with each run of overlapping spans replaced by one marker."""
    if text is None or not spans:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b, _ in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], "[secret]"]
        at = b
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, threshold: float = 0.45) -> DataFrame:
    """All columns of docs; secrets in text replaced, and n_chars, where there is one, counted again."""
    names, types = docs.columns, docs.schema
    at = names.index("text")

    def run(batches):
        for b in batches:
            texts = [redact_text(t, scan_text(t, threshold)[1]) for t in b.column(at).to_pylist()]
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns)]
            if "n_chars" in names:
                i = names.index("n_chars")
                old = b.column(i).to_pylist()
                before = b.column(at).to_pylist()
                cols[i] = pa.array([o if t == p else len(t) for o, t, p in zip(old, texts, before)], b.column(i).type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, types)


def secret_report(docs: DataFrame) -> DataFrame:
    """The digest columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""

    def run(batches):
        for b in batches:
            counts, shas, texts = [], [], []
            for text in b.column(1):
                base, spans = scan_text(text.as_py())
                kinds = Counter(k for _, _, k in base)
                counts.append(kinds)
                shas.append(hashlib.sha256(digest(base).encode()).hexdigest())
                texts.append(digest(spans))
            cols = [pa.array([c[k] for c in counts], pa.int64()) for k in KINDS[:3]]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array(shas), pa.array(texts)], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
