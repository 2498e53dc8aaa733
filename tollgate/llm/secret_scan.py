"""Secret scan: keyword prefilter, anchored expressions near hits, checksums.

An Aho-Corasick automaton over the lower-cased text finds keywords; only there
is an expression tried, anchored at the hit.  Runs of hex digits have no
keyword and are found by one character class.  Tokens that carry a checksum or
a checkable header are added only if it holds: GitHub and npm tokens (the last
six characters are the CRC-32 of the thirty before, in base 62) and JSON web
tokens (the header decodes to a JSON object with ``alg``).

The plan is a projection without a shuffle, and every expression is linear: no
nested repeats, and a hit inside an earlier match is skipped.

Defined cases: a NULL or empty text has no spans; matches of a kind never
overlap, and a match that fails its check is consumed without a retry;
repeated rows are scanned each; other columns pass through in ``row``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tollgate.llm.common import pack, python_tasks, read_table

BASE_KINDS = ("assign", "access", "hex")
#: In the order of the output.
KINDS = (*BASE_KINDS, "github", "npm", "jwt")
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
            "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
            "npm_": "npm", "eyj": "jwt"}
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CHECKED = {"github": re.compile(r"gh[pousr]_([A-Za-z0-9]+)"), "npm": re.compile(r"npm_([A-Za-z0-9]+)")}
_JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
RESULT = "array<struct<kind: string, start: int, end: int>>"


def checksum62(body: str) -> str:
    """CRC-32 in base 62, six characters."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = _BASE62[digit] + out
    return out


def _valid_header(part: str) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, RecursionError):  # the last: nested too deep for a header
        return False
    return isinstance(head, dict) and "alg" in head


def _match(kind: str, text: str, at: int) -> tuple[int, bool] | None:
    """(end, holds) of the kind's expression anchored at the position."""
    if kind == "assign":
        m = _ASSIGN.match(text, at)
        return m and (m.end(), len(m[2]) >= 6)
    if kind == "access":
        m = _ACCESS.match(text, at)
        return m and (m.end(), m.end() - at >= 20)
    if kind == "jwt":
        m = _JWT.match(text, at)
        return m and (m.end(), _valid_header(m[1]))
    m = _CHECKED[kind].match(text, at)
    return m and (m.end(), len(m[1]) == 36 and checksum62(m[1][:30]) == m[1][30:])


def keyword_automaton():
    import ahocorasick
    automaton = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        automaton.add_word(word, (len(word), kind))
    automaton.make_automaton()
    return automaton


def secret_spans(text: str | None, automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    if not text:
        return []
    lowered = text.lower()
    if len(lowered) != len(text):  # one letter lower-cases to two characters
        lowered = text.replace("İ", "i").lower()
    hits = sorted((end - size + 1, kind) for end, (size, kind) in automaton.iter(lowered))
    out, reached = [], dict.fromkeys(KINDS, 0)
    for at, kind in hits:
        if at >= reached[kind] and (found := _match(kind, text, at)):
            reached[kind] = found[0]
            if found[1]:
                out.append((at, found[0], kind))
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _scanner():
    @arrow_udf(RESULT)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = keyword_automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for column in batches:
            yield pa.array([[{"kind": k, "start": a, "end": b} for a, b, k in secret_spans(t, automaton)] for t in column.to_pylist()], kind)
    return scan


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` packed as ``row`` with the array ``found`` of its spans."""
    python_tasks(docs.sparkSession)
    return pack(docs).withColumn("found", _scanner()(F.col("row.text")))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return out.select(F.col("row.doc_id").alias("doc_id"), *map(count, BASE_KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
