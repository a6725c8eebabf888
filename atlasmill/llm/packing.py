"""Vector bin packing of tokenised documents into sequences.

A piece is a vector of tokens, segments and loss-bearing tokens. Documents longer than a sequence fill whole ones; a rest goes
into the open sequence that it fits under all three limits with the largest dot product of its vector and the room left, both
in units of the limits. If it fits none and no more may be opened, it is cut to fill the one that takes most of it. What is open
at the end of a partition is packed tight, and the last rest is cut at powers of two, which need no padding. Memory is bounded
by the open sequences; no row leaves its partition, so nothing is shuffled.

Defined results: null and empty texts are one token, the end id; repeated rows are packed each; a null id stays null; other
columns are ignored. A partition's result depends on its rows in their order alone, so a lost task gives the same again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasmill.llm import bpe
from atlasmill.llm.workspace import prepare, table

OPEN = 32
COLUMNS = {"id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "loss_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
SCHEMA = ", ".join(f"{c} long" for c in COLUMNS)


class Ids:
    """Little-endian 32-bit ids of a text, special tokens by their names. The library merges by id, which is the order of merges here."""

    def __init__(self, path: str):
        import tiktoken

        self.vocab = v = bpe.vocabulary(path)
        order = [new for _, new in sorted(v.merges.values())]
        if order != sorted(order):
            raise ValueError(f"ids of {path} don't follow the order of its merges")
        self.library = tiktoken.Encoding("vocabulary", pat_str=bpe.PATTERN, mergeable_ranks=v.ids, special_tokens={})

    def of(self, text: str) -> bytes:
        if self.vocab.split is None or not any(s in text for s in self.vocab.special):
            return self.plain(text)
        parts = self.vocab.split.split(text)
        return b"".join(self.vocab.special[x].to_bytes(4, "little") if i % 2 else self.plain(x) for i, x in enumerate(parts))

    def plain(self, text: str) -> bytes:
        try:
            return self.library.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        except ValueError:  # a run of white space too long for the library's expressions
            core = self.library._core_bpe
            return np.concatenate([np.array(core.encode_single_piece(p.encode()), "<u4") for p in self.vocab.pattern.findall(text)]).tobytes()


_ids: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _ids:
        _ids[path] = Ids(path)
    return _ids[path]


class Piece:
    __slots__ = ("doc", "start", "ids", "total", "free")

    def __init__(self, doc, start: int, ids: bytes, total: int, free: int = 0):
        self.doc, self.start, self.ids, self.total, self.free = doc, start, ids, total, free

    def __len__(self) -> int:
        return len(self.ids) // 4

    def loss(self) -> int:
        """All bear loss but the free first ids of a document, its prompt, and the end id, its last."""
        return max(0, min(self.start + len(self), self.total - 1) - max(self.start, self.free))

    def room(self, tokens: int, loss: int) -> int:
        """How many of its first ids fit."""
        free = max(0, min(self.free - self.start, len(self)))
        n = min(tokens, len(self), free + loss)
        return min(tokens, len(self)) if n >= self.total - 1 - self.start else n

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[: 4 * n], self.total, self.free), Piece(self.doc, self.start + n, self.ids[4 * n :], self.total, self.free)


class Packer:
    def __init__(self, part: int, tokens: int, segments: int, loss: int, open_: int = OPEN):
        self.limit = np.array([tokens, segments, loss], float)
        self.room = np.tile(self.limit, (open_, 1))
        self.open: list[list[Piece]] = [[] for _ in range(open_)]
        self.tokens, self.segments, self.loss = tokens, segments, loss
        self.next, self.rows = part << 32, []

    def close(self, pieces: list[Piece]) -> None:
        at = 0
        for p in pieces:
            self.rows.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, p.loss(), self.next, at))
            at += len(p)
        self.next += 1

    def put(self, i: int, p: Piece) -> None:
        self.open[i].append(p)
        self.room[i] -= (len(p), 1, p.loss())
        if self.room[i, :2].min() < 1:
            self.close(self.open[i])
            self.open[i], self.room[i] = [], self.limit

    def add(self, doc, ids: bytes, free: int = 0) -> None:
        p = Piece(doc, 0, ids, len(ids) // 4, free)
        while p.room(self.tokens, self.loss) < len(p) or len(p) == self.tokens:
            n = p.room(self.tokens, self.loss)
            if n < self.tokens:  # its loss fills a sequence, its tokens don't
                break
            full, p = p.cut(n)
            self.close([full])
            if not len(p):
                return
        while p is not None:
            need = np.array([len(p), 1, p.loss()])
            score = np.where((self.room >= need).all(axis=1), (self.room / self.limit) @ (need / self.limit), -1.0)
            i = int(score.argmax())
            if score[i] >= 0:
                self.put(i, p)
                return
            fits = [p.room(int(t), int(x)) for t, _, x in self.room]
            i = max(range(len(fits)), key=fits.__getitem__)
            if not fits[i]:  # every open one is full of loss: the fullest goes as it is
                i = int(self.room[:, 0].argmin())
                self.close(self.open[i])
                self.open[i], self.room[i] = [], self.limit
                continue
            first, p = p.cut(fits[i]) if fits[i] < len(p) else (p, None)
            self.put(i, first)

    def finish(self) -> None:
        left = [p for pieces in self.open for p in pieces]
        self.open = [[] for _ in self.open]
        self.room[:] = self.limit
        run: list[Piece] = []
        size = loss = 0
        for p in left:  # in turn, each sequence filled before the next
            while p is not None:
                fits = p.room(self.tokens - size, self.loss - loss)
                if fits:
                    first, p = p.cut(fits) if fits < len(p) else (p, None)
                    run.append(first)
                    size, loss = size + len(first), loss + first.loss()
                if not fits or size == self.tokens or len(run) == self.segments:
                    self.close(run)
                    run, size, loss = [], 0, 0
        while size:  # the rest, at powers of two
            want, now = 1 << (size.bit_length() - 1), []
            size -= want
            while want:
                p = run.pop(0)
                if len(p) > want:
                    p, rest = p.cut(want)
                    run.insert(0, rest)
                now.append(p)
                want -= len(p)
            self.close(now)

    def take(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [[] for _ in COLUMNS]
        self.rows = []
        return pa.record_batch({c: pa.array(x, t) for (c, t), x in zip(COLUMNS.items(), cols, strict=True)})


def pack(spark: SparkSession, docs: DataFrame, vocab_path: str, max_tokens: int = 2048, max_segments: int = 64, max_loss: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None) -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, loss_tokens, sequence_id, offset.

    A sequence holds at most max_tokens tokens, max_segments pieces and max_loss loss-bearing tokens. prompt_col: a text whose ids come before those
    of the text and bear no loss, as prompts in instruction data; a null one is empty. Without it all ids but the end id bear loss, so then a max_loss under
    max_tokens leaves room that is padding.
    """
    prepare(spark)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, packer = ids_of(vocab_path), Packer(TaskContext.get().partitionId(), max_tokens, max_segments, max_loss)
        for batch in batches:
            for doc, text, prompt in zip(*(batch.column(c) for c in ("id", "text", "prompt")), strict=True):
                text, prompt = text.as_py(), prompt.as_py()
                first = ids.of(prompt) if prompt else b""
                packer.add(doc.as_py(), first + (ids.of(text) if text else b"") + end, len(first) // 4)
            yield packer.take()
        packer.finish()
        yield packer.take()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), (F.col(prompt_col) if prompt_col else F.lit(None)).cast("string").alias("prompt"))
    return rows.mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
