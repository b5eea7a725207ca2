"""Secret scans through a trigram inverted index.

Each rule's regular expression yields a Boolean query over trigrams that any match must contain.  For
every block of documents, postings (trigram -> documents) are built for the trigrams of all queries in
one vectorised pass over the bytes; AND intersects and OR unites postings; the expression then runs on
the candidates only.  A rule that has no mandatory trigrams scans every document of the block.  Blocks
are Arrow batches, so nothing is shuffled and a lost block is simply scanned again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changegrid.llm.words import rounds

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse


@dataclass(frozen=True)
class Rule:
    """``kind``: name in the output. A match counts if its group ``group`` has ``least`` or more characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    either_case: bool = False
    base: bool = True

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.either_case else 0))


#: Base rules in the order of their kinds, then those that this scan adds.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", base=False),
)

#: Strings a part of an expression may be expanded into before it counts as unknown.
_MOST = 16


@dataclass
class _Part:
    """What a part of an expression can match: all its strings if few (``exact``), and a query any match satisfies."""

    exact: set[str] | None
    query: tuple


def _all(*parts: tuple) -> tuple:
    found = [p for p in parts if p != ("any",)]
    return ("any",) if not found else found[0] if len(found) == 1 else ("and", *found)


def _grams(strings: set[str] | None) -> tuple:
    """Any of ``strings`` occurs: OR over strings of AND over trigrams; no demand if one is short."""
    if not strings or any(len(s) < 3 for s in strings):
        return ("any",)
    each = [_all(*(("gram", g) for g in dict.fromkeys(s[i : i + 3] for i in range(len(s) - 2)))) for s in sorted(strings)]
    return each[0] if len(each) == 1 else ("or", *each)


def _walk(parsed) -> _Part:
    """Concatenation of parsed items: runs of small exact sets grow together; others end the run."""
    run: set[str] = {""}
    whole, queries = True, []
    for op, arg in parsed:
        part = _item(op, arg)
        joined = {a + b for a, b in product(run, part.exact)} if part.exact is not None and len(run) * len(part.exact) <= _MOST else None
        if joined is not None:
            run = joined
            continue
        queries += [_grams(run), part.query]
        run = part.exact if part.exact is not None else {""}
        whole = False
    return _Part(run, _grams(run)) if whole else _Part(None, _all(*queries, _grams(run)))


def _item(op, arg) -> _Part:
    if op is sre.LITERAL:
        return _Part({chr(arg).lower()}, ("any",))
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < _MOST:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return _Part(None, ("any",))
        return _Part(chars if len(chars) <= 8 else None, ("any",))
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        ways = [_walk(way) for way in arg[1]]
        exact = set().union(*(w.exact for w in ways)) if all(w.exact is not None for w in ways) else None
        queries = [w.query for w in ways]
        query = ("any",) if ("any",) in queries else ("or", *queries)
        return _Part(exact if exact and len(exact) <= _MOST else None, query)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        part = _walk(inner)
        if low == 0:
            return _Part({"", *part.exact} if high == 1 and part.exact is not None else None, ("any",))
        if low == high == 1:
            return part
        if part.exact is not None and len(part.exact) == 1 and low == high and low <= _MOST:
            return _Part({next(iter(part.exact)) * low}, ("any",))
        return _Part(None, part.query)
    if op is sre.AT:
        return _Part({""}, ("any",))
    return _Part(None, ("any",))


def trigram_query(rule: Rule) -> tuple:
    """The Boolean query of a rule, over lower-case trigrams: ("any",), ("gram", s), ("and", ...) or ("or", ...).

    Texts are indexed in lower case (ASCII), so a query holds for matches in any case.
    """
    found = _walk(sre_parse.parse(rule.pattern))
    return _ascii(_all(found.query, _grams(found.exact)))


def _ascii(query: tuple) -> tuple:
    """Drops demands on trigrams beyond ASCII, which the byte index does not hold."""
    if query[0] == "gram":
        return query if query[1].isascii() else ("any",)
    if query[0] in ("and", "or"):
        parts = [_ascii(p) for p in query[1:]]
        if query[0] == "or":
            return ("any",) if ("any",) in parts else ("or", *parts)
        return _all(*parts)
    return query


def grams_of(query: tuple) -> set[str]:
    return {query[1]} if query[0] == "gram" else set().union(set(), *(grams_of(p) for p in query[1:])) if query[0] != "any" else set()


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


class Index:
    """Postings of a block's texts for the trigrams of all rules' queries."""

    def __init__(self, grams: list[str]):
        self.grams = {g: i for i, g in enumerate(sorted(grams))}
        self.slot = np.zeros(1 << 24, np.uint8 if len(grams) < 255 else np.uint16)
        for g, i in self.grams.items():
            a, b, c = g.encode()
            self.slot[a << 16 | b << 8 | c] = i + 1

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """For each trigram, which of the texts contain it."""
        n = len(offsets) - 1
        held = np.zeros((len(self.grams), n), bool)
        if len(data) >= 3 and self.grams:
            low = _LOWER[data]
            slots = self.slot[(low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]]
            at = np.flatnonzero(slots)
            text = np.searchsorted(offsets, at, "right") - 1
            inside = at + 3 <= offsets[text + 1]
            held[slots[at[inside]].astype(np.int64) - 1, text[inside]] = True
        return held

    def candidates(self, query: tuple, held: np.ndarray, n: int) -> np.ndarray:
        if query[0] == "any":
            return np.ones(n, bool)
        if query[0] == "gram":
            return held[self.grams[query[1]]]
        parts = [self.candidates(p, held, n) for p in query[1:]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)


def spans_of(text: str, rule: Rule, compiled: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches in code points; those that fail the length test are dropped."""
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, text, *keep, spans)`` for every row; ``spans`` is array<struct<start, end, kind, base>>, ordered by start, then rule.

    Positions are code points, end exclusive, on the whole text; null text counts as empty.  Rows keep
    their multiplicity, null ids too; columns other than the id, the text and those named in ``keep`` are left out.
    An empty table gives no rows.
    """
    queries = [trigram_query(r) for r in rules]
    grams = sorted(set().union(*(grams_of(q) for q in queries)))
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *keep)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, compiled = Index(grams), [r.compiled() for r in rules]
        for batch in batches:
            texts = batch.column("text")
            for row, to, data, offsets in rounds(texts):
                held = index.postings(data, offsets)
                block = texts.slice(row, to - row).to_pylist()
                found: list[list[tuple]] = [[] for _ in block]
                for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                    for i in np.flatnonzero(index.candidates(query, held, to - row)):
                        if block[i]:
                            found[i] += [(a, k, b) for a, b in spans_of(block[i], rule, compiled[k])]
                spans = [[{"start": a, "end": b, "kind": rules[k].kind, "base": rules[k].base} for a, k, b in sorted(x)] for x in found]
                yield pa.RecordBatch.from_arrays([*(c.slice(row, to - row) for c in batch.columns), pa.array(spans, pa.list_(span))], names=[*batch.schema.names, "spans"])

    found = T.ArrayType(T.StructType().add("start", "long").add("end", "long").add("kind", "string").add("base", "boolean"))
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields, T.StructField("spans", found)]))


def redact(text: F.Column, spans: F.Column) -> F.Column:
    """The text with every span, overlapping ones merged, replaced by ``<kind>`` of its first rule."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        begins = s["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(begins, F.concat(acc["out"], gap, F.lit("<"), s["kind"], F.lit(">"))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step)
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))).otherwise(text)


def span_text(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return scan(docs).select(F.col("id").alias("doc_id"), *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def brute_force(text: str | None, rules: tuple[Rule, ...] = RULES) -> tuple[str, str]:
    """(digest of base spans, all spans) of one text without the index; for tests."""
    found = sorted((a, k, b) for k, r in enumerate(rules) for a, b in spans_of(text or "", r, r.compiled()))
    told = [(rules[k].base, f"{rules[k].kind}:{a}:{b}") for a, k, b in found]
    return hashlib.sha256(",".join(x for base, x in told if base).encode()).hexdigest(), ",".join(x for _, x in told)
