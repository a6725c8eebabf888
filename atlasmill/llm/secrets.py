"""Secret scans: all rules as one minimised automaton, run over the bytes of many texts at a time in one pass.

A batch of texts is cut into streams at pairs of bytes after which every rule's automaton is in its first state whatever came
before, so no match spans a cut; the streams are stepped together through the transition array. Only streams in which a rule's bit came
up are walked again, with that rule's own automata: from right to left for the places where a match begins, then from each of these
that is free to the right for its longest match. So the time is linear in the text. Matches that are too short are dropped.

Defined results: null and empty texts have no spans; repeated rows are scanned each; a null id stays null; other columns are
ignored. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm.automaton import Automaton, compile_all
from atlasmill.llm.workspace import prepare, table


@dataclass(frozen=True)
class Rule:
    """scan: what the combined automaton looks for, within each match that counts. What follows value in a match must have least characters."""

    kind: str
    pattern: str
    least: int
    scan: str
    either_case: bool = False
    value: str = ""


#: The base kinds in their order, then public token formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=\-]+)""", 6, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]""", True, r"""^\w+?["']?\x20*[:=]\x20*["']?"""),
    Rule("access", r"AKIA[A-Z0-9]+", 20, r"AKIA[A-Z0-9]"),
    Rule("hex", r"[0-9a-f]+", 24, r"[0-9a-f]{24}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40, r"gh[pousr]_"),
    Rule("slack", r"xox[abprs]\-[A-Za-z0-9\-]+", 15, r"xox[abprs]\-"),
    Rule("google", r"AIza[A-Za-z0-9_\-]+", 39, r"AIza"),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", 30, r"\.eyJ"),
    Rule("private_key", r"\-\-\-\-\-BEGIN ((RSA|EC|DSA|OPENSSH|ENCRYPTED) )?PRIVATE KEY\-\-\-\-\-", 20, r"PRIVATE KEY\-\-\-\-\-"),
)
BASE = ("assign", "access", "hex")
STREAM, CHUNK = 320, 1 << 20


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.all = compile_all([(r.scan, r.either_case) for r in rules], unanchored=True)
        self.each = [(compile_all([(r.pattern, r.either_case)], unanchored=False), compile_all([(r.pattern, r.either_case)], unanchored=True, backwards=True)) for r in rules]
        self.rest = np.logical_and.reduce([compile_all([(r.pattern, r.either_case)], unanchored=True).rests() for r in rules]).ravel()
        # states renumbered so that those with a match are the last; a state is kept as its place in the transition array
        order = np.argsort(self.all.accepts > 0, kind="stable")
        name = np.argsort(order, kind="stable")
        self.step = (name[self.all.next[order]] * 256).astype(np.intp).ravel()
        self.accepts = self.all.accepts[order]
        self.found = int((self.accepts == 0).sum()) * 256
        self.listed = self.step.tolist()
        assert self.found and not order[0]

    def flagged(self, buf: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
        """(first, end, bits) of the streams in which some rule came up. at: where texts begin, and the end."""
        pair = buf[:-1].astype(np.int32) * 256 + buf[1:]
        cut = np.flatnonzero(self.rest[pair]) + 2
        want = np.searchsorted(cut, np.arange(STREAM, len(buf), STREAM))
        first = np.unique(np.concatenate([at[:-1], cut[want[want < len(cut)]]]))
        first = first[first < len(buf)]
        size = np.diff(np.append(first, len(buf)))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        state, seen = np.zeros(len(first), np.intp), np.zeros(len(first), np.intp)
        steps = min(int(size[0]), 4 * STREAM)
        active = np.searchsorted(-size, -np.arange(1, steps + 1), "right")
        for t, m in enumerate(active.tolist()):
            at_t = state[:m]
            np.take(self.step, at_t + buf.take(first[:m] + t), out=at_t, mode="clip")
            np.maximum(seen[:m], at_t, out=seen[:m])
        for i in range(int(np.searchsorted(-size, -steps, "left"))):  # the few without a place to cut
            now, most, step = int(state[i]), int(seen[i]), self.listed
            for b in buf[first[i] + steps : first[i] + size[i]].tobytes():
                now = step[now + b]
                most = max(most, now)
            seen[i] = most
        hit = np.flatnonzero(seen >= self.found)
        return [(int(first[i]), int(first[i] + size[i]), self.bits(buf[first[i] : first[i] + size[i]].tobytes())) for i in hit]

    def bits(self, data: bytes) -> int:
        state, out = 0, 0
        for b in data:
            state = self.listed[state + b]
            if state >= self.found:
                out |= int(self.accepts[state >> 8])
        return out

    def spans(self, data: bytes, a: int, b: int, bits: int) -> list[tuple[int, int, int]]:
        """(start, end, rule) within a stream, as places in data."""
        out = []
        for k, r in enumerate(self.rules):
            if bits >> k & 1:
                for s, e in matches(*self.each[k], data, a, b):
                    value = data[s:e]
                    if r.value:
                        value = value[re.match(r.value.encode(), value, re.ASCII).end() :]
                    if len(value) >= r.least:
                        out.append((s, e, k))
        return out

    def scan(self, texts: list[str | None]) -> Iterator[list[tuple[int, int, int]]]:
        """For each text its spans (start, end, rule) in code points, by start and then rule."""
        run: list[bytes] = []
        for i, t in enumerate(texts):
            run.append(t.encode("utf-8", "surrogatepass") if t else b"")
            if i + 1 == len(texts) or sum(map(len, run[-64:])) > CHUNK // 4 or len(run) >= 256:
                yield from self._run(run)
                run = []

    def _run(self, run: list[bytes]) -> list[list[tuple[int, int, int]]]:
        out: list[list[tuple[int, int, int]]] = [[] for _ in run]
        data = b"".join(run)
        if data:
            at = np.concatenate(([0], np.cumsum([len(x) for x in run])))
            for a, b, bits in self.flagged(np.frombuffer(data, np.uint8), at):
                out[int(np.searchsorted(at, a, "right")) - 1] += self.spans(data, a, b, bits)
            for i, found in enumerate(out):
                place, chars = int(at[i]), 0  # bytes of a match are characters
                for j, (s, e, k) in enumerate(sorted(found, key=lambda x: (x[0], x[2]))):
                    chars += len(data[place:s].decode("utf-8", "surrogatepass"))
                    place, found[j] = s, (chars, chars + e - s, k)
        return out


def matches(auto: Automaton, back: Automaton, data: bytes, a: int, b: int) -> Iterator[tuple[int, int]]:
    """Leftmost, longest, non-overlapping, within data[a:b]."""
    step, accepts, _ = _lists(back)
    state, begins = 0, []
    for i in range(b - 1, a - 1, -1):
        state = step[state][data[i]]
        if accepts[state]:
            begins.append(i)
    step, accepts, dead = _lists(auto)
    end = a
    for i in reversed(begins):
        if i < end:
            continue
        state, j = 0, i
        while j < b:
            state = step[state][data[j]]
            if dead[state]:
                break
            j += 1
            if accepts[state]:
                end = j
        yield i, end


def _lists(auto: Automaton):
    if not hasattr(auto, "lists"):
        auto.lists = auto.next.tolist(), auto.accepts.tolist(), auto.dead.tolist()
    return auto.lists


@cache
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def find_secrets(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' columns and secret_spans, an array of (start, end, kind), by start and then the order of the rules. A column of docs of that name is left out."""
    prepare(spark)
    docs = docs.drop("secret_spans")
    from pyspark.sql import types as T

    kinds = [r.kind for r in rules]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner(rules)
        for b in batches:
            found = [[{"start": x, "end": y, "kind": kinds[k]} for x, y, k in spans] for spans in s.scan(b.column(text_col).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, span)], names=[*b.schema.names, "secret_spans"])

    out = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("secret_spans", out)]))


def redact(spark: SparkSession, docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """docs with each stretch of text that spans cover replaced by <kind> of the first of them; other texts as they are."""
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner(rules)
        for b in batches:
            texts = b.column(text_col).to_pylist()
            for i, spans in enumerate(s.scan(texts)):
                if spans:
                    out, at = [], 0
                    for x, y, k in spans:
                        if x >= at:
                            out += [texts[i][at:x], f"<{rules[k].kind}>"]
                        at = max(at, y)
                    texts[i] = "".join(out) + texts[i][at:]
            cols = [pa.array(texts, pa.string()) if n == text_col else c for n, c in zip(b.schema.names, b.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _is(kind: str):
    return lambda x: x.kind == kind


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    base = F.filter("secret_spans", lambda x: x.kind.isin(*BASE))
    counts = [F.size(F.filter("secret_spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("secret_spans").alias("spans"))


def spans_digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
