"""Secrets in texts: spans by fixed patterns, and spans whose format likelihood is that of labelled credentials.

1. The patterns find the base spans, which always stay. Their values are the labelled credentials.
2. Of each kind's distinct values, and of all other tokens as background, the ``sample`` with the smallest hashes are
   kept, task by task and then over all: a bounded sample that doesn't depend on how rows are dealt.
3. For each kind and the background an automaton is inferred from three quarters of its sample (grammar.py), with the lengths' frequencies beside it.
   The last quarter calibrates it: a kind's values must pass a floor of likelihood a character, and background tokens
   stay below a limit of the ratio of both likelihoods.
4. Every token of every text that touches no base span is scored by all automata; one that passes a kind's
   floor and limit is a span of that kind, the one with the largest ratio.

Defined cases
- text null or empty: no spans
- a kind with fewer than ``least`` values in its sample: no automaton, so its spans are the base ones
- id null: the row is treated as any other; repeated rows: each gives its spans
- very long texts and tokens: scanned and scored whole
- an empty table: no rows; extra columns are ignored, whatever their names
"""

from __future__ import annotations

import heapq
import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, releasing, slices, written
from .grammar import Grammar, inferred

SLICE_BYTES = 1 << 22
KINDS = ("assign", "access", "hex")
BACKGROUND = "other"


def _either_case(words: str) -> str:
    """A pattern whose ASCII letters match in both cases, and no other character does."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


_ASSIGN = re.compile(f"({_either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile("AKIA[A-Z0-9]{12,}")  # the longest match from each start, so the same as matching and dropping what is short
_HEX = re.compile("[0-9a-f]{32,}")
_TOKEN = re.compile("[A-Za-z0-9+/_.=-]{8,}")
#: Distinct tokens whose kind a worker remembers; beyond, it starts afresh.
MEMORY = 300_000


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value) in order."""
    found = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def other_tokens(text: str, spans: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, token) of all tokens that touch none of the spans."""
    covered, k = [], 0
    for start, _, end, _ in spans:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(end, covered[-1][1])
        else:
            covered.append([start, end])
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if k == len(covered) or covered[k][0] >= end:
            yield start, end, m[0]


@dataclass
class Format:
    """How tokens of a kind look."""

    grammar: Grammar
    log_length: np.ndarray  # by length; the last place is for all longer ones
    floor: float = -np.inf

    def scores(self, words: list[bytes], size: np.ndarray) -> np.ndarray:
        return self.grammar.scores(words) + self.log_length[np.minimum(size, len(self.log_length) - 1)]


def _sizes(words: list[bytes]) -> np.ndarray:
    return np.array([len(w) for w in words], np.int64)


def learned(words: list[bytes], alpha: float, slack: float, longest: int = 256) -> tuple[Format, list[bytes]]:
    """The format of three quarters of the words, calibrated by the rest, which is returned as well."""
    fit, rest = [w for k, w in enumerate(words) if k % 4], words[::4]
    counts = np.bincount(np.minimum(_sizes(fit), longest), minlength=longest + 1) + 0.5 / longest
    out = Format(inferred(fit, alpha), np.log(counts / counts.sum()))
    out.floor = float(np.quantile(out.scores(rest, _sizes(rest)) / _sizes(rest), 0.01)) - slack
    return out, rest


@dataclass
class Formats:
    kinds: dict[int, Format]  # by number
    limits: dict[int, float]
    background: Format | None
    evidence: float  # nats by which a kind must be likelier than the background

    def classify(self, words: list[bytes]) -> list[int]:
        """The kind's number of each word, -1 for none."""
        best, value = np.full(len(words), -1), np.full(len(words), -np.inf)
        if words and self.kinds:
            size = _sizes(words)
            plain = self.background.scores(words, size)
            for k, kind in self.kinds.items():
                own = kind.scores(words, size)
                ratio = own - plain
                good = (own / size >= kind.floor) & (ratio / size > self.limits[k]) & (ratio >= self.evidence) & (ratio > value)
                best[good], value[good] = k, ratio[good]
        return best.tolist()


def samples(docs: DataFrame, sample: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """kind, value, h: of each kind's distinct values, and of all other tokens, those with the smallest hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {k: {} for k in (*KINDS, BACKGROUND)}
        limit = dict.fromkeys(held, 1 << 32)

        def add(kind: str, value: str) -> None:
            h = zlib.crc32(value.encode())
            if h < limit[kind] and value not in held[kind]:
                held[kind][value] = h
                if len(held[kind]) > 4 * sample:
                    held[kind] = dict(heapq.nsmallest(sample, held[kind].items(), key=lambda x: (x[1], x[0])))
                    limit[kind] = 1 + max(held[kind].values())

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for text in part.column("text").to_pylist():
                    spans = base_spans(text or "")
                    for _, k, _, value in spans:
                        add(KINDS[k], value)
                    for _, _, token in other_tokens(text or "", spans):
                        add(BACKGROUND, token)
        rows = [(k, v, h) for k, found in held.items() for v, h in heapq.nsmallest(sample, found.items(), key=lambda x: (x[1], x[0]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["kind", "value", "h"])

    found = written(mapped(docs.select(F.col(text_col).alias("text")), work, "kind string, value string, h long"))
    kept = None
    for kind in (*KINDS, BACKGROUND):
        # The sort keeps `sample` rows a task; few rows come in, as each task has sent no more.
        own = found.where(F.col("kind") == kind).distinct().orderBy("h", "value").limit(sample)
        kept = own if kept is None else kept.unionByName(own)
    return written(kept)


def learn(sampled: DataFrame, alpha: float = 0.05, slack: float = 0.05, least: int = 20, evidence: float = 10.0) -> Formats:
    """Formats of the kinds in samples(); one task a kind works on a bounded sample."""

    def work(table: pa.Table) -> pa.Table:
        kind, words = table.column("kind")[0].as_py(), sorted(v.encode() for v in table.column("value").to_pylist())
        words = [w for _, w in sorted((zlib.crc32(w[::-1]), w) for w in words)]
        blob = pickle.dumps(learned(words, alpha, slack)) if len(words) >= least else None
        return pa.table({"kind": pa.array([kind], pa.string()), "format": pa.array([blob], pa.binary())})

    rows = sampled.groupBy("kind").applyInArrow(releasing(work), "kind string, format binary").collect()
    found = {r["kind"]: pickle.loads(bytes(r["format"])) for r in rows if r["format"]}
    if BACKGROUND not in found:
        return Formats({}, {}, None, evidence)
    background, tokens = found.pop(BACKGROUND)
    kinds = {KINDS.index(k): f for k, (f, _) in found.items()}
    size = _sizes(tokens)
    plain = background.scores(tokens, size)
    limits = {}
    for k, f in kinds.items():
        own = f.scores(tokens, size)
        passing = own / size >= f.floor  # only background that a kind's floor lets through has to be told apart by the ratio
        ratio = ((own - plain) / size)[passing]
        limits[k] = float(np.quantile(ratio, 0.99)) if len(ratio) >= least else 0.0
    return Formats(kinds, limits, background, evidence)


def find(docs: DataFrame, formats: Formats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans (array of kind, start, end, base: code points, end exclusive, in order of start and kind)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                base = [base_spans(t) for t in texts]
                if len(known) > MEMORY:
                    known.clear()
                if formats.kinds:
                    tokens = [list(other_tokens(t, b)) for t, b in zip(texts, base, strict=True)]
                    new = list({t for found in tokens for _, _, t in found} - known.keys())
                    known.update(zip(new, formats.classify([t.encode() for t in new]), strict=True))
                else:
                    tokens = [[]] * len(texts)
                spans = []
                for own, others in zip(base, tokens, strict=True):
                    every = [(s, k, e, True) for s, k, e, _ in own] + [(s, known[t], e, False) for s, e, t in others if known[t] >= 0]
                    spans.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in sorted(every)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(narrow, work, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find_secrets(docs: DataFrame, sample: int = 4000, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, spans: as find(), by formats learned from docs themselves."""
    return find(docs, learn(samples(docs, sample, id_col, text_col), **options), id_col, text_col)


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
