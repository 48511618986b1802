"""Vector bin packing of training sequences by the dot-product heuristic.

An example is a vector (tokens, segments, loss-bearing tokens) and a sequence
has a limit for each. The open sequence takes, among the examples that still
fit all limits, the one whose normalised vector has the largest dot product
with the room that is left, so examples that use what is plentiful go first.
Packing runs inside each partition over a bounded window of waiting examples:
no shuffle, no group in one task, and a lost task is simply run again.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import slices, strings
from layercake.llm.tokenize import Memo, chunks_of, vocabulary


@dataclass(frozen=True)
class Limits:
    """Most tokens, segments and loss-bearing tokens of a sequence; ``window`` examples wait at a time."""

    tokens: int = 1024
    segments: int = 256
    loss: int = 1024
    window: int = 1024


class Packer:
    """Packs examples ``(key, tokens, loss)`` as they come; ``cut`` allows cutting them.

    ``add`` and ``finish`` return closed sequences: lists of ``(key, start,
    tokens)``. Without ``cut`` an example that passes a limit by itself gets
    a sequence of its own. With ``cut``, examples are cut to fill a sequence
    and a sequence that stays short is dealt into lengths that are powers of
    two. Loss-bearing tokens of a cut example are its first ones: the part
    that goes first takes as many of them as it has tokens.
    """

    def __init__(self, limits: Limits, cut: bool):
        self.limits, self.cut = limits, cut
        self.most = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.keys: list = []
        self.starts: list[int] = []
        self.need = np.zeros((2 * limits.window + 8, 3))  # rows up to len(keys) are in use

    def add(self, key, tokens: int, loss: int) -> list[list[tuple]]:
        done, start = [], 0
        if self.cut:
            whole = min(self.limits.tokens, self.limits.loss)
            while tokens >= whole:  # a full sequence by itself
                done += self._short([(key, start, whole)])
                start, tokens, loss = start + whole, tokens - whole, max(0, loss - whole)
        elif tokens > self.limits.tokens or loss > self.limits.loss:
            return [[(key, 0, tokens)]]
        if tokens or not start:
            self._wait(key, start, tokens, loss)
        if len(self.keys) >= 2 * self.limits.window:
            while len(self.keys) > self.limits.window:
                done += self._one()
        return done

    def finish(self) -> list[list[tuple]]:
        done = []
        while self.keys:
            done += self._one()
        return done

    def _wait(self, key, start: int, tokens: int, loss: int) -> None:
        self.need[len(self.keys)] = tokens, 1, loss
        self.keys.append(key)
        self.starts.append(start)

    def _take(self, i: int) -> tuple:
        """Removes waiting example ``i``; the last one takes its row."""
        got = (self.keys[i], self.starts[i], int(self.need[i, 0]), int(self.need[i, 2]))
        last = len(self.keys) - 1
        self.need[i] = self.need[last]
        self.keys[i], self.starts[i] = self.keys[last], self.starts[last]
        self.keys.pop()
        self.starts.pop()
        return got

    def _one(self) -> list[list[tuple]]:
        room, items = self.most.copy(), []
        while self.keys:
            need = self.need[: len(self.keys)]
            fits = (need <= room).all(axis=1)
            if fits.any():
                gain = np.where(fits, need @ (room / self.most**2), -1.0)
                key, start, tokens, loss = self._take(int(gain.argmax()))
                items.append((key, start, tokens))
                room -= (tokens, 1, loss)
                continue
            gap = int(min(room[0], room[2]))
            if self.cut and gap > 0 and room[1] >= 1:  # fill the gap with the front of the longest
                key, start, tokens, loss = self._take(int(need[:, 0].argmax()))
                items.append((key, start, gap))
                room -= (gap, 1, min(loss, gap))
                self._wait(key, start + gap, tokens - gap, max(0, loss - gap))
            break
        return self._short(items) if self.cut else [items]

    def _short(self, items: list[tuple]) -> list[list[tuple]]:
        """A sequence under the token limit is dealt into lengths that are powers of two (no padding)."""
        total = sum(x[2] for x in items)
        if total in (0, self.limits.tokens):
            return [items]
        out, room = [], 0
        for key, start, tokens in items:
            while tokens:
                if not room:
                    room = 1 << (total.bit_length() - 1)
                    total -= room
                    out.append([])
                part = min(room, tokens)
                out[-1].append((key, start, part))
                start, tokens, room = start + part, tokens - part, room - part
        return out


def pack_examples(df: DataFrame, example_id: str, tokens: str, loss: str, limits: Limits = Limits()) -> DataFrame:
    """``(example_id, n_tokens, n_loss, sequence_id, offset)``: whole examples (such as conversations) under all three limits.

    Null or negative counts count as 0; a null id is a value like any other;
    repeated rows are examples of their own; an example that passes a limit
    alone gets its own sequence. ``sequence_id`` is unique over the result.
    """

    def run(batches):
        packer, serial = Packer(limits, cut=False), TaskContext.get().partitionId() << 36

        def out(done):
            nonlocal serial
            rows = []
            for items in done:
                at = 0
                for (key, n, m), _, tokens in items:
                    rows.append((key, n, m, serial, at))
                    at += tokens
                serial += 1
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kind, *[pa.int64()] * 4))], ["example_id", "n_tokens", "n_loss", "sequence_id", "offset"])

        kind = pa.null()
        for batch in batches:
            kind = batch.column("example_id").type
            done = []
            for key, n, m in zip(*(batch.column(c).to_pylist() for c in ("example_id", "n_tokens", "n_loss"))):
                done += packer.add((key, n, m), n, m)
            if done:
                yield out(done)
        done = packer.finish()
        if done:
            yield out(done)

    count = lambda c: F.greatest(F.coalesce(F.col(c).cast("bigint"), F.lit(0)), F.lit(0))
    source = df.select(F.col(example_id).alias("example_id"), count(tokens).alias("n_tokens"), count(loss).alias("n_loss"))
    id_kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(run, f"example_id {id_kind}, n_tokens bigint, n_loss bigint, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, vocabulary_path: str, limits: Limits = Limits(), separator: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Tokenise whole texts and pack them, cut freely, into sequences; one row per piece.

    ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.
    A document is its ids and then ``separator``, which bears no loss; null
    text is empty, so it is the separator alone. Every id lies in one piece;
    repeated rows are documents of their own; a null id is kept as null. Only
    the window's examples (each under one sequence long) are held in memory.
    """

    def run(batches):
        voc = vocabulary(vocabulary_path)
        memo = Memo(lambda c: np.array(voc.merge(c), "<u4").tobytes())
        end = np.array([separator], "<u4").tobytes()
        packer, serial = Packer(limits, cut=True), TaskContext.get().partitionId() << 36
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        kind = pa.null()

        def out(done):
            nonlocal serial
            rows = []
            for items in done:
                at = 0
                for (key, ids, skipped, n), start, tokens in items:
                    part = ids[4 * (start - skipped) : 4 * (start - skipped + tokens)]
                    rows.append((key, start, tokens, zlib.crc32(part), n, serial, at))
                    at += tokens
                serial += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (kind, *[pa.int64()] * 6))], names)

        for batch in slices(batches, "text"):
            kind = batch.column("doc_id").type
            memo.trim()
            done = []
            for key, text_ in zip(batch.column("doc_id").to_pylist(), strings(batch.column("text"))):
                ids = b"".join([memo[c] for c in chunks_of(text_)]) + end
                done += packer.add((key, ids, 0, len(ids) // 4), len(ids) // 4, len(ids) // 4 - 1)
            # what still waits keeps only its own ids, not those of its whole document
            for i, ((key, ids, skipped, n), start) in enumerate(zip(packer.keys, packer.starts)):
                if start > skipped:
                    packer.keys[i] = (key, ids[4 * (start - skipped) :], start, n)
            if done:
                yield out(done)
        done = packer.finish()
        if done:
            yield out(done)

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    id_kind = source.schema[0].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {id_kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
