"""Operator 5: secret scans through an incremental blob ledger."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import addressed, bring_up_to_date
from .shared import kept_names, shared_dir
from .text import Chunk, any_of, chunks, owner, runs, worker

#: The base kinds, in their order; a match must also pass the test beside it.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}
#: Spans that the ledger's own rules add: kind, literal that any match holds, pattern.
ADDED = {
    "pem": (b"PRIVATE KEY", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[\s\S]*?-----END (?:[A-Z]+ )*PRIVATE KEY-----)?")),
    "github": (b"gh", re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}")),
    "slack": (b"xox", re.compile(r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}")),
    "google": (b"AIza", re.compile(r"\bAIza[0-9A-Za-z_-]{35}")),
    "jwt": (b"eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "userinfo": (b"://", re.compile(r"\b[a-z][a-z0-9+.-]{0,30}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@")),
}
RULES_VERSION = hashlib.sha256(repr([(k, p.pattern) for k, (p, _) in BASE.items()] + [(k, p.pattern) for k, (_, p) in ADDED.items()]).encode()).hexdigest()

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX = any_of((0x30, 0x39), (0x61, 0x66))


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans, and all spans, of a text: kind, start, end (code points), in order."""
    order = [*BASE, *ADDED]
    base = [(k, m.start(), m.end()) for k, (p, test) in BASE.items() for m in p.finditer(text) if test(m)]
    added = [(k, m.start(), m.end()) for k, (_, p) in ADDED.items() for m in p.finditer(text)]
    place = lambda x: (x[1], order.index(x[0]), x[2])
    return sorted(base, key=place), sorted(base + added, key=place)


def _may_match(chunk: Chunk) -> np.ndarray:
    """Rows that hold something every match of some rule holds."""
    starts, ends = runs(_HEX[chunk.data], chunk.bounds)
    out = np.zeros(chunk.rows, bool)
    out[owner(chunk.bounds, starts[ends - starts >= 24])] = True
    raw = chunk.data.tobytes()
    low = raw.lower()
    for where, literal in [*((low, w) for w in _WORDS), (raw, b"AKIA"), *((raw, x) for x, _ in ADDED.values())]:
        at = where.find(literal)
        while at >= 0:
            i = int(owner(chunk.bounds, np.array([at]))[0])
            out[i] = True
            at = where.find(literal, int(chunk.bounds[i + 1]))
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in worker("secrets", batches):
        for c in chunks(batch.column("__text")):
            n = np.zeros((3, c.rows), np.int64)
            digests, spans = [nothing] * c.rows, [""] * c.rows
            for i in np.flatnonzero(_may_match(c)).tolist():
                base, every = scan(c.text(i).decode("utf-8"))
                for j, kind in enumerate(BASE):
                    n[j, i] = sum(x[0] == kind for x in base)
                digests[i], spans[i] = hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)
            yield pa.RecordBatch.from_arrays([batch.column("__digest").slice(c.first, c.rows), *map(pa.array, n), pa.array(digests, pa.string()), pa.array(spans, pa.string())], ["__digest", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_scan(df: DataFrame, ledger_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Findings of every row, as a path (with the columns in ``keep``, such as a version or a file name) to a blob.

    ``ledger_path`` names a lasting ledger; None starts an empty one. A later call scans
    only blobs, or rule versions, that it lacks. Null and empty texts have no findings.
    A null id, repeated rows, ties and copies are kept, one row out for each row in; columns
    not asked for are not read, and one in ``keep`` whose name a result has gets an underscore.
    An empty table gives an empty result; a text of any length is scanned whole, a long one
    alone. ``findings`` unfolds the spans.
    """
    rows = addressed(df, id_col, text_col, keep)
    found = bring_up_to_date(df, rows, id_col, text_col, RULES_VERSION, ledger_path or shared_dir(df.sparkSession, "secret-ledger"), _run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    results = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
    names = kept_names(id_col, keep, results)
    return rows.join(found, "__digest", "left").select(F.col("__id").alias(id_col), *(F.col(f"__kept.c{i}").alias(names[k]) for i, k in enumerate(names)), *results)


def findings(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each span: id, kind, start, end."""
    part = F.split("span", ":")
    return scanned.where("spans <> ''").select(id_col, F.explode(F.split("spans", ",")).alias("span")).select(id_col, part[0].alias("kind"), part[1].cast("long").alias("start"), part[2].cast("long").alias("end"))
