"""Byte-level BPE with a memory-mapped lexicon transducer.

Method: chunk counts over the whole corpus give the frequent chunks (a chunk is
what stands between two single spaces, with the space before it); they are
compiled, with their ids, into a minimal acyclic automaton with shared suffixes
whose arc outputs sum to the chunk's number, and that number names its slice of
the id array. Workers memory-map the arrays and walk all chunks of a batch
together. Chunks outside the lexicon are merged exactly by the merge ranks.

Why chunks: a single space between two non-space characters always starts a
new pre-token, and no pre-token looks past it, so the ids of a text are the
ids of its chunks in order. Where white space runs, the run stays inside a chunk.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import open_array, save_array, shared_folder, slices, strings

_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pre-token pattern of the byte-level vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def chunks_of(text: str) -> list[str]:
    """The chunks of a text; joined they give the text again."""
    if not text:
        return []
    if _RUN.search(text) or text[0].isspace() or text[-1].isspace():
        parts = _CUT.split(text)
    else:
        parts = text.split(" ")
    return [parts[0], *[" " + x for x in parts[1:]]]


def _bytes_of_letters() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


class Vocabulary:
    """Merge ranks and special tokens of a byte-level tokenizer file (.json of the tokenizers library)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _bytes_of_letters()
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.ids = {bytes(letters[ch] for ch in w): i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        self.words: list[bytes] = [b""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for w, i in self.ids.items():
            self.words[i] = w
        for w, i in self.special.items():
            self.words[i] = w.encode()
        self._engine = tiktoken.Encoding("layercake", pat_str=PATTERN, mergeable_ranks=self.ids, special_tokens=self.special)
        self._marks = tuple(self.special)

    def merge(self, chunk: str) -> list[int]:
        """Exact ids of one chunk by the merge ranks; special tokens in it count as such."""
        if any(m in chunk for m in self._marks):
            return self._engine.encode(chunk, allowed_special="all")
        return self._engine.encode_ordinary(chunk)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Memo(dict):
    """Chunk -> value, filled by ``make`` and emptied when it holds ``most`` entries (bounded memory, same results)."""

    def __init__(self, make, most: int = 250_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


# --- the automaton ------------------------------------------------------------------------------------------------


def build_transducer(entries: dict[bytes, list[int]]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of the keys, as arrays.

    ``arc_key`` = state * 256 + byte, ascending; ``arc_to`` the next state;
    ``arc_out`` how many smaller keys leave the state before this arc;
    ``final`` whether a key ends in the state. The sum of outputs on a key's
    path (plus one for each final state passed) is its rank among the sorted
    keys; ``id_at[rank]:id_at[rank+1]`` is its slice of ``ids``.
    """
    keys = sorted(entries)
    register: dict[tuple, int] = {}
    arcs: list[tuple] = []  # of registered states: (final, ((byte, state), ...))
    path: list[list] = [[False, []]]  # unfrozen states of the last key: [final, arcs]

    def freeze(state: list) -> int:
        sign = (state[0], tuple(state[1]))
        number = register.get(sign)
        if number is None:
            number = register[sign] = len(arcs)
            arcs.append(sign)
        return number

    last = b""
    for key in keys:
        same = 0
        while same < min(len(last), len(key)) and last[same] == key[same]:
            same += 1
        for depth in range(len(last), same, -1):
            number = freeze(path.pop())
            path[-1][1].append((last[depth - 1], number))
        for _ in key[same:]:
            path.append([False, []])
        path[-1][0] = True
        last = key
    for depth in range(len(last), 0, -1):
        number = freeze(path.pop())
        path[-1][1].append((last[depth - 1], number))
    root = freeze(path.pop())
    below = np.zeros(len(arcs), np.int64)  # keys that can be read from a state; targets are frozen before their sources
    key_, to, out = [], [], []
    for state, (final, edges) in enumerate(arcs):
        n = int(final)
        for byte, target in edges:
            key_.append(state * 256 + byte)
            to.append(target)
            out.append(n)
            n += int(below[target])
        below[state] = n
    lengths = [len(entries[k]) for k in keys]
    return {
        "arc_key": np.array(key_, np.int64), "arc_to": np.array(to, np.int64), "arc_out": np.array(out, np.int64),
        "final": np.array([a[0] for a in arcs], bool), "root": np.array([root], np.int64),
        "id_at": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        "ids": np.array([i for k in keys for i in entries[k]], np.int64),
    }


def walk(t: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Rank of every word in the automaton, -1 if it is not there; all words move a byte at a time together."""
    if not words:
        return np.zeros(0, np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    state = np.full(len(words), t["root"][0], np.int64)
    rank = np.zeros(len(words), np.int64)
    alive = np.arange(len(words))
    n_arcs = len(t["arc_key"])
    result = np.full(len(words), -1, np.int64)
    step = 0
    while len(alive):
        ended = size[alive] == step
        done = alive[ended]
        done = done[t["final"][state[done]]]
        result[done] = rank[done]
        alive = alive[~ended]
        if not len(alive) or not n_arcs:
            break
        want = state[alive] * 256 + flat[at[alive] + step]
        k = np.minimum(np.searchsorted(t["arc_key"], want), n_arcs - 1)
        there = t["arc_key"][k] == want
        alive, k = alive[there], k[there]
        rank[alive] += t["arc_out"][k]
        state[alive] = t["arc_to"][k]
        step += 1
    return result


# --- Spark --------------------------------------------------------------------------------------------------------


def count_chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(chunk, n)`` over all texts; each task adds up its own chunks before the shuffle."""

    def run(batches):
        have: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(have.keys(), pa.string()), pa.array(have.values(), pa.int64())], ["chunk", "n"])
            have.clear()
            return batch

        for batch in slices(batches, "text"):
            for x in strings(batch.column("text")):
                have.update(chunks_of(x))
            if len(have) > 400_000:
                yield out()
        if have:
            yield out()

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "chunk string, n bigint").groupBy("chunk").agg(F.sum("n").alias("n"))


def frequent_chunks(docs: DataFrame, size: int, text: str = "text", longest: int = 64) -> list[str]:
    """At most ``size`` chunks, the most frequent; where a count's ties would pass ``size``, none of that count.

    Chunks of over ``longest`` characters are left to the merges, so what reaches the driver is bounded by ``size * longest``.
    """
    from layercake.llm.importance import kth_largest  # that module imports this one

    counts = count_chunks(docs, text).where((F.col("n") > 1) & (F.length("chunk") <= longest))
    spark = docs.sparkSession
    folder = shared_folder(spark, "chunk-counts")
    counts.write.parquet(folder)
    counts = spark.read.parquet(folder)
    if size < 1:
        return []
    floor = kth_largest(counts, "n", size)  # None: there are fewer than ``size``
    frequent = counts if floor is None else counts.where(F.col("n") >= floor)
    if frequent.count() > size:
        frequent = counts.where(F.col("n") > floor)
    return [r["chunk"] for r in frequent.select("chunk").collect()]


def compile_lexicon(docs: DataFrame, vocabulary_path: str, size: int = 65_536, text: str = "text") -> str:
    """Count, compile and store the lexicon; returns its folder in the shared checkpoint folder."""
    voc = vocabulary(vocabulary_path)
    arrays = build_transducer({w.encode(): voc.merge(w) for w in frequent_chunks(docs, size, text) if w})
    folder = shared_folder(docs.sparkSession, "lexicon")
    for name, array in arrays.items():
        save_array(folder, name, array)
    return folder


@lru_cache(maxsize=8)
def lexicon(folder: str) -> dict[str, np.ndarray]:
    return {n: open_array(folder, n) for n in ("arc_key", "arc_to", "arc_out", "final", "root", "id_at", "ids")}


def ids_by_lexicon(words: list[str], t: dict[str, np.ndarray], voc: Vocabulary) -> list[list[int]]:
    """Ids of chunks: from the automaton where it has them, else merged."""
    ranks = walk(t, [w.encode() for w in words]).tolist()
    at, ids = t["id_at"], t["ids"]
    return [ids[at[r] : at[r + 1]].tolist() if r >= 0 else voc.merge(w) for w, r in zip(words, ranks)]


def encode_decode(docs: DataFrame, folder: str, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>, decoded string)`` of every whole text (null: empty)."""

    def run(batches):
        t, voc, memo = lexicon(folder), vocabulary(vocabulary_path), Memo(None)
        for batch in slices(batches, "text"):
            memo.trim()
            cut = [chunks_of(x) for x in strings(batch.column("text"))]
            new = list(set().union(*cut).difference(memo))
            memo.update(zip(new, ids_by_lexicon(new, t, voc)))
            ids = [[i for c in chunks for i in memo[c]] for chunks in cut]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([voc.decode(x).decode("utf-8", "replace") for x in ids], pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, folder: str, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Count and SHA-256 digests of the ids (decimal, comma-joined) and of the decoded text, per document.

    Null or empty text: no ids, digests of the empty string. Same walk and
    merges as ``encode_decode``; ids never leave the worker. Repeated rows give repeated results.
    """

    def run(batches):
        t, voc, memo = lexicon(folder), vocabulary(vocabulary_path), Memo(None)
        for batch in slices(batches, "text"):
            memo.trim()
            cut = [chunks_of(x) for x in strings(batch.column("text"))]
            new = list(set().union(*cut).difference(memo))
            for word, ids in zip(new, ids_by_lexicon(new, t, voc)):
                memo[word] = (len(ids), ",".join(map(str, ids)), voc.decode(ids))
            n, a, b = [], [], []
            for chunks in cut:
                got = [memo[c] for c in chunks]
                n.append(sum([g[0] for g in got]))
                a.append(hashlib.sha256(",".join([g[1] for g in got]).encode()).hexdigest())
                # bytes that are no UTF-8 are decoded as replacement characters, as the library does
                b.append(hashlib.sha256(b"".join([g[2] for g in got]).decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode_ids(df: DataFrame, vocabulary_path: str, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, text)`` of id arrays (null or empty: ''); special tokens are kept."""

    def run(batches):
        voc = vocabulary(vocabulary_path)
        for batch in batches:
            texts = [voc.decode(x or []).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = df.select(doc_id).schema[0].dataType.simpleString()
    return df.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")
