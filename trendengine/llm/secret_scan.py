"""Secrets in texts: fixed patterns, and a battery of randomness tests over long tokens.

Patterns give the base spans. The method adds tokens that look drawn at random. A candidate is a run of 20 or more
characters of the base64 alphabets, with ``=`` at its end only, as padding: what follows it (``NAME=value``, ``?sig=value``) is a
candidate of its own. Its encoding (hex, lower-case letters, base32, base62, base64) is inferred from the
characters. Where the run fits none, or cannot pass as a whole, its parts between separators (``+ /``, ``- _``, or all four) are the
candidates instead, so a path or name before a token does not hide it. Three tests ask whether it is uniform in that encoding: chi-squared over the alphabet, runs about the middle of
the alphabet, serial correlation at lag 1. A token whose randomness any of them rejects (Bonferroni, level `REJECT`) is
text, a counter or padding. For the others the chi-squared statistic is set against ordinary writing of the same length and
alphabet, where it is noncentral with a noncentrality of length times `surplus`: the chance of so even a token in ordinary
writing is its p-value. So short tokens need more evidence. Of overlapping candidates the one with the smallest p-value stays, then the longest, then the
first, its p-value times the number of parts tested in the run; so added spans never overlap. A token that repeats in a document is one test.
Benjamini-Hochberg over the tests of the document keeps the expected share of false finds at `FDR`, document by document: other documents do not
change a verdict.

Narrow: one pass, no shuffle, state of one document at a time, linear in its length. A null or empty text has no spans. Repeated rows are scanned alike.
Ties in place are listed by kind. Documents keep their other columns, of any name and type.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendengine.llm.common import any_columns, fresh, table, with_column

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:=++(?![A-Za-z0-9+/_-]))?")
PARTS = [re.compile(p) for p in (r"[A-Za-z0-9_-]{20,}=*", r"[A-Za-z0-9+/]{20,}=*", r"[A-Za-z0-9]{20,}=*")]
LEAST = 12
KINDS = ("assign", "access", "hex", "random")
REJECT, FDR = 0.001, 0.01
MARK = "[SECRET]"

#: The alphabets by name, smallest first.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "letters": LOWER,
    "base32": UPPER + "234567",
    "base62": UPPER + LOWER + DIGITS,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
#: Chance that two letters of ordinary writing are the same.
COINCIDENCE = 0.066

Span = tuple[int, str, int]  # start, kind, end: sorts by start


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the fixed patterns. Runs that are too short fail, as greedy runs have no longer part."""
    found = []
    if ":" in text or "=" in text:
        found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def normal_tail(z: float) -> float:
    """Chance of a normal value above z."""
    return math.erfc(z / math.sqrt(2)) / 2


def infer(token: str) -> str | None:
    """The smallest encoding that holds all characters; none for plain numbers."""
    chars = set(token)
    if chars <= set(DIGITS):
        return None
    return next((name for name, alphabet in ENCODINGS.items() if chars <= set(alphabet)), None)


def surplus(size: int) -> float:
    """Noncentrality per character of ordinary writing in an alphabet of ``size``; hex can spell with six letters only."""
    return size / 6 - 1 if size == 16 else size * COINCIDENCE - 1


def battery(token: str, alphabet: str) -> tuple[float, float, float, float]:
    """The chi-squared statistic, then the p-values of uniformity, runs and serial correlation under randomness."""
    n, size = len(token), len(alphabet)
    place = {c: i for i, c in enumerate(alphabet)}
    x = [place[c] for c in token]
    counts: dict[int, int] = {}
    for v in x:
        counts[v] = counts.get(v, 0) + 1
    chi = size / n * sum(c * c for c in counts.values()) - n
    df = size - 1
    uniform = normal_tail(((chi / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df)))
    high = [v >= size / 2 for v in x]
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean, spread = 1 + (n - 1) / 2, math.sqrt(n - 1) / 2
    p_runs = 2 * normal_tail(abs(runs - mean) / spread)
    middle = sum(x) / n
    off = [v - middle for v in x]
    power = sum(v * v for v in off)
    r = sum(a * b for a, b in zip(off, off[1:])) / power if power else 1.0
    p_serial = 2 * normal_tail(abs(r + 1 / n) * math.sqrt(n))
    return chi, uniform, p_runs, p_serial


def p_ordinary(chi: float, n: int, size: int) -> float:
    """Chance that ordinary writing of n characters spreads as evenly: left tail of a noncentral chi-squared."""
    df, shift = size - 1, n * surplus(size)
    return normal_tail(-(chi - df - shift) / math.sqrt(2 * (df + 2 * shift)))


def p_candidate(run: str) -> float | None:
    """The p-value of a run without its padding; none if it fits no encoding."""
    token = run.rstrip("=")
    name = infer(token)
    if name is None:
        return None
    alphabet = ENCODINGS[name]
    chi, *ps = battery(token, alphabet)
    return p_ordinary(chi, len(token), len(alphabet)) if 3 * min(ps) >= REJECT else 1.0


def candidates(start: int, run: str) -> list[tuple[float, int, int]]:
    """(p-value, start, end) of a run or, if its p-value is none or above every threshold, of disjoint parts of it."""
    p = p_candidate(run)
    whole = [] if p is None else [(p, start, start + len(run))]
    if whole and p <= FDR:
        return whole
    spans = {m.span() for pattern in PARTS for m in pattern.finditer(run)} - {(0, len(run))}
    parts = [(q, a, b) for a, b in spans if (q := p_candidate(run[a:b])) is not None]
    chosen: list[tuple[float, int, int]] = []
    for q, a, b in sorted(parts, key=lambda x: (x[0], x[1] - x[2], x[1])):
        if not any(a < e and d < b for _, d, e in chosen):
            chosen.append((min(1.0, q * len(parts)), a, b))
    return [(q, start + a, start + b) for q, a, b in chosen] or whole


def random_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Tokens that pass as random, without those that overlap with ``taken``."""
    found = [c for m in TOKEN.finditer(text) for c in candidates(m.start(), m[0])]
    tests: dict[str, float] = {}
    for p, start, end in found:
        token = text[start:end]
        tests[token] = min(p, tests.get(token, 1.0))
    ranked = sorted(tests.values())
    passed = max((p for k, p in enumerate(ranked, 1) if p <= FDR * k / len(ranked)), default=-1.0)
    return [("random", s, e) for _, s, e in sorted(found) if tests[text[s:e]] <= passed and not any(s < b and a < e for _, a, b in taken)]


def scan(text: str | None) -> tuple[list, list]:
    """Base spans and added spans, each sorted by start, then kind as listed."""
    if not text:
        return [], []
    order = lambda span: (span[1], KINDS.index(span[0]))
    base = base_spans(text)
    return sorted(base, key=order), sorted(random_spans(text, base), key=order)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span, or union of overlapping spans, replaced with MARK."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            out += [text[at:start], MARK]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_secrets(docs: DataFrame, name: str = "secrets") -> DataFrame:
    """``docs`` with a struct ``name``: base and added spans, and the redacted text (null where nothing was found)."""

    def make():
        def work(columns):
            out = []
            for text in columns[0].to_pylist():
                base, added = scan(text)
                out.append(
                    {
                        "base": [dict(zip(("kind", "start", "end"), s)) for s in base],
                        "added": [dict(zip(("kind", "start", "end"), s)) for s in added],
                        "redacted": redact(text, base + added) if base or added else None,
                    }
                )
            return out

        return work

    kind = StructType.fromDDL(f"x struct<base:{SPANS},added:{SPANS},redacted:string>")[0].dataType
    return with_column(docs, ["text"], name, kind, make)


@any_columns("text", "n_chars")
def redact_secrets(docs: DataFrame) -> DataFrame:
    """The documents, each secret replaced with MARK; n_chars follows where the table has it. All rows stay."""
    name = fresh("secrets", docs)
    found = find_secrets(docs, name)
    changed = F.col(f"{name}.redacted")
    columns = {"text": F.coalesce(changed, "text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed.isNotNull(), F.length(changed).cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns(columns).select(*docs.columns)


def _line(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("secrets.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    place = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), s["kind"].alias("kind"), s["end"].alias("end"))
    every = F.array_sort(F.transform(F.concat("secrets.base", "secrets.added"), place))
    return found.select(
        "doc_id",
        *(n(kind) for kind in KINDS[:3]),
        F.sha2(_line(F.col("secrets.base")), 256).alias("base_sha256"),
        _line(every).alias("spans"),
    )
